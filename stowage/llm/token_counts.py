"""Token counts by whole-token shortcut.

A BPE merge never crosses certain places, whatever the text: where the vocabulary has no piece that holds both
sides. ``Shortcut.prove`` checks on the model file, before any text is read, that

* no piece has a word mark behind another character, so text can be cut before each run of word marks, and
* characters that occur in no piece of two or more characters stand alone, so text can be cut around line breaks.

It then encodes every vocabulary string alone and keeps those that come out as exactly one token. A pre-token
found among them counts one without any merging; only the others are merged, each distinct one once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"  # fixed value: what the library writes for a space
BREAK = "\n"
MEMO = 200_000  # merged pre-tokens remembered by a worker

SCHEMA = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]


class Shortcut(dict):
    """Tokens of a pre-token; missing ones are merged by the library and remembered."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.cut = self.prove()
        self.whole = {w: 1 for w in self.single_tokens()}
        super().__init__(self.whole)

    def prove(self) -> re.Pattern | None:
        """The pattern of pre-tokens, or None where the model allows no such cuts."""
        model = self.model
        pieces = self.strings()
        if any(MARK in p.lstrip(MARK) for p in pieces) or any(BREAK in p for p in pieces):
            return None
        # The library must do no more to a text than write marks for spaces and one mark in front.
        for probe in ("  a b ", "\u00c5\ufb01\u3000x\t"):
            if model.normalize(probe) != MARK + probe.replace(" ", MARK):
                return None
        return re.compile(f"{MARK}*[^{MARK}{BREAK}]+|{MARK}+|{BREAK}")

    def strings(self) -> list[str]:
        model = self.model
        inner = (model.is_byte, model.is_control, model.is_unknown)
        return [model.id_to_piece(k) for k in range(model.get_piece_size()) if not any(f(k) for f in inner)]

    def single_tokens(self) -> list[str]:
        """Vocabulary strings that, alone as a pre-token, encode to exactly one token."""
        model = self.model
        alone = [s for s in self.strings() if s != MARK]
        encoded = model.encode([self.source(s) for s in alone], num_threads=1)
        single = [s for s, ids in zip(alone, encoded) if len(ids) - self.lead(s) == 1]
        return [*single, *([MARK] if len(model.encode(BREAK)) == 2 else [])]

    @staticmethod
    def source(pre_token: str) -> str:
        """A text whose encoding holds the pre-token's: the mark in front is the one the library adds."""
        return pre_token[1:] if pre_token[0] == MARK else BREAK + pre_token

    @staticmethod
    def lead(pre_token: str) -> int:
        """Tokens of ``source`` that belong to its helper prefix: a mark and a line break."""
        return 0 if pre_token[0] == MARK else 2

    def __missing__(self, pre_token: str) -> int:
        if len(self) >= MEMO + len(self.whole):
            self.clear()
            self.update(self.whole)
        n = 1 if pre_token == MARK else len(self.model.encode(self.source(pre_token))) - self.lead(pre_token)
        self[pre_token] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.cut is None:
            return len(self.model.encode(text))
        return sum(map(self.__getitem__, self.cut.findall(MARK + text.replace(" ", MARK))))


_LOADED: dict[str, Shortcut] = {}


def loaded(model_file: str) -> Shortcut:
    if model_file not in _LOADED:
        _LOADED[model_file] = Shortcut(model_file)
    return _LOADED[model_file]


def token_counts(
    docs: DataFrame, model_file: str, text: str = "text", limit: int = 4096, keep: list[str] | None = None
) -> DataFrame:
    """Per row: the columns ``keep`` (default ``doc_id``), ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One pass without a shuffle; a row's work depends on its own text only. A null text counts as empty: 0 bytes,
    0 tokens. Repeated rows stay repeated, an empty table gives an empty result, and columns that are not kept
    may have any name. Texts are never cut; the memory of a worker is one batch and a bounded memo.
    """
    keep = ["doc_id"] if keep is None else keep
    thin = docs.select(*[docs[c] for c in keep], docs[text].alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(model_file)
        for batch in batches:
            texts = pc.fill_null(batch.column(batch.num_columns - 1), "")
            n = pa.array([tokens.count(t.as_py()) for t in texts], pa.int64())
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            names = [*batch.schema.names[:-1], *[name for name, _ in SCHEMA]]
            columns = [*batch.columns[:-1], sizes, n, pc.greater(n, limit)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([*thin.schema.fields[:-1], *[T.StructField(n, t) for n, t in SCHEMA]])
    return thin.mapInArrow(count, schema)
