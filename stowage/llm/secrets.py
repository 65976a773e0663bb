"""Secrets in text: fixed patterns, and values in a credential context that would be costly to guess.

The cost of guessing a value is that of its cheapest segmentation: each segment is a known word, a date, a
repeated character, a walk over neighbouring keys, or brute force, and costs the decimal logarithm of the
guesses it takes. The minimum is found by dynamic programming over positions. A value in a context such as
``pwd: ...`` or ``Kennwort: ...`` whose cheapest segmentation costs at least ``least_cost`` is a secret; ``pwd: changeme`` is not.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, with the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones need not be looked at
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "guess"]

# Names in front of a value, beyond the base patterns, in English, German, French and Spanish. Behind those of PASSES a
# quoted value may hold blanks; those of SHORT are common words or parts of them, so only a sign states their value.
PASSES = (
    r"pass[\x20_-]?(?:word|wd|phrase|code)|pwd|pa(?:ss|ß)wort|kennwort|mot[\x20_-]de[\x20_-]passe|mdp|"
    r"phrase[\x20_-]de[\x20_-]passe|contrase[nñÑ]a"
)
KEYS = (
    r"secret|token|credentials?|(?:api|access|private|auth)[\x20_-]?key|geheimnis|zugangs(?:daten|code|schl[uüÜ]ssel)|"
    r"api[\x20_-]?schl[uüÜ]ssel|jeton|cl[eéÉ][\x20_-](?:api|priv[eéÉ]e|d['’]acc[eèÈ]s)|secreto|"
    r"clave[\x20_-](?:api|privada|de[\x20_-]acceso)"
)
SHORT = r"(?<![A-Za-z])(?:(?:db|user)?pass|clave|cl[eéÉ])"
SIGN = r"[\x20\t]*(?:[:=]>?|->)[\x20\t]*"
CONTEXT = re.compile(
    rf"""(?:(?P<phrase>{PASSES})|{KEYS})["']?(?:(?P<sign>{SIGN})|[\x20\t]+(?:is|was|ist|war|lautet|est|es|era)[\x20\t]+)|"""
    rf"""{SHORT}["']?(?P<stated>{SIGN})|(?P<bearer>bearer[\x20\t]+)""",
    re.A | re.I,
)
# What every such name and every base assignment holds, and a run of digits, for Arrow's linear matcher: texts without go
# unsearched.
HINT = (
    r"""(?i)pass|paß|pwd|secret|token|key|credential|kennwort|geheimnis|zugang|schl[uü]ssel|mdp|jeton|cl[eé]["'\x20\t:=_-]|"""
    r"clave|contrase|bearer"
)
DIGITS = "[0-9a-f]{24}"
QUOTED = re.compile(r""""([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`""")
BARE = re.compile(r"""["'`]?([^\s"'`<>]+)""")
OPENED = {")": "(", "]": "[", "}": "{"}

# Rows of the keyboard, for walks.
ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
# Words that people choose, by falling frequency.
CHOSEN = [
    "password", "admin", "welcome", "login", "letmein", "secret", "master", "dragon", "monkey", "root", "user", "test",
    "guest", "changeme", "default", "example", "required", "optional", "token", "access", "string", "value", "none", "null",
    "true", "false", "your", "here", "redacted", "hidden", "xxxx", "public", "private", "key", "pass",
]
DATE = re.compile(
    r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d"
)
LEET = str.maketrans("@43015$7", "aaeoisst")
WORD_MOST = 24  # longest dictionary word
WALK, STEP = math.log10(47 * 4), 0.1  # logarithms: where a walk starts and turns, and each of its keys


def _neighbours() -> dict[str, str]:
    out: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, a in enumerate(row):
            near = {row[k] for k in (x - 1, x + 1) if 0 <= k < len(row)}
            for other in ROWS[max(0, y - 1) : y] + ROWS[y + 1 : y + 2]:
                near |= {other[k] for k in (x - 1, x, x + 1) if 0 <= k < len(other)}
            out[a] = near
    return {a: "".join(sorted(b)) for a, b in out.items()}


NEAR = _neighbours()


def brute_cost(char: str) -> float:
    """Guesses for one character of its class, as a logarithm."""
    if char.isascii():
        return math.log10(10 if char.isdigit() else 26 if char.isalpha() else 33)
    return 2.5


def guess_cost(value: str, words: dict[str, float]) -> float:
    """Logarithm of the guesses for the cheapest segmentation of ``value``, in time linear in its length.

    ``words`` has the cost of each known lower-case word. Capitals and look-alike digits add to a word's cost.
    """
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    dates: dict[int, list[int]] = {}
    for k in range(n):
        if value[k].isdigit() and (m := DATE.match(value, k)):
            dates.setdefault(k, []).append(m.end())
    repeat, walk = 1, 1
    starts: dict[int, list[tuple[int, float]]] = {}
    for k in range(1, n + 1):  # maximal runs, entered where they begin
        alike = k < n and value[k] == value[k - 1]
        near = k < n and low[k] in NEAR.get(low[k - 1], "")
        if alike:
            repeat += 1
        else:
            if repeat >= 3:
                starts.setdefault(k - repeat, []).append((k, brute_cost(value[k - 1]) + math.log10(repeat)))
            repeat = 1
        if near:
            walk += 1
        else:
            if walk >= 4:
                starts.setdefault(k - walk, []).append((k, WALK + STEP * walk))
            walk = 1
    best = [0.0] + [math.inf] * n
    for k in range(n):
        at = best[k]
        if (c := at + brute_cost(value[k])) < best[k + 1]:
            best[k + 1] = c
        for end, cost in starts.get(k, ()):
            if at + cost < best[end]:
                best[end] = at + cost
        for end in dates.get(k, ()):
            if at + 4.6 < best[end]:
                best[end] = at + 4.6
        for end in range(k + 3, min(n, k + WORD_MOST) + 1):
            cost = words.get(low[k:end])
            if cost is None and (cost := words.get(plain[k:end])) is not None:
                cost += 0.6
            if cost is not None:
                if value[k:end] != low[k:end]:
                    cost += 0.5
                if at + cost < best[end]:
                    best[end] = at + cost
    return best[n]


def marked(texts: pa.Array) -> Iterator[tuple[str, bool, bool]]:
    """Each text (null: empty), whether it may name a credential, and whether it has a long run of digits."""
    texts = pc.fill_null(texts, "")
    marks = (pc.match_substring_regex(texts, p).to_pylist() for p in (HINT, DIGITS))
    return zip((t.as_py() for t in texts), *marks)


def base_spans(text: str, named: bool = True, digits: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in code points; the marks tell what need not be looked for."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]] if named else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if digits:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def value_end(text: str, start: int, stop: int) -> int:
    """End of a value without quotes: stops of the sentence go, and brackets that close nothing in the value."""
    over = {c: text.count(c, start, stop) - text.count(o, start, stop) for c, o in OPENED.items()}
    while stop > start:
        c = text[stop - 1]
        if over.get(c, 0) > 0:
            over[c] -= 1
        elif c not in ".,;:":
            break
        stop -= 1
    return stop


def contexts(text: str) -> Iterator[tuple[int, int, bool, bool]]:
    """Values named as credentials: (start, stop, whether a sign states it, whether it follows ``bearer``).

    A quoted value goes to its closing quote in the same line. With blanks in it, that holds only behind the name of a
    password or passphrase and a sign; elsewhere, its first word counts.
    """
    at = 0
    while m := CONTEXT.search(text, at):
        at = m.end()
        stated = m["sign"] is not None or m["stated"] is not None
        quoted = QUOTED.match(text, at)
        if quoted and (m["phrase"] and m["sign"] is not None or not re.search(r"\s", quoted[quoted.lastindex])):
            yield *quoted.span(quoted.lastindex), stated, m["bearer"] is not None
            at = quoted.end()
        elif bare := BARE.match(text, at):
            yield bare.start(1), value_end(text, *bare.span(1)), stated, m["bearer"] is not None
            at = bare.end()


def guess_spans(text: str, words: dict[str, float], least_cost: float) -> list[tuple[int, int, int]]:
    """Values in a credential context that are costly to guess.

    A value needs a digit or sign, or else letters of both cases behind a colon, equals sign or arrow: single
    words of prose are no secrets, however rare, nor is one that ends in ``!`` or ``?``. Behind ``bearer`` it needs a
    digit.
    """
    found = []
    for start, stop, stated, bearer in contexts(text):
        value = text[start:stop]
        if bearer:
            likely = any(c.isdigit() for c in value)
        else:
            likely = any(not c.isalpha() for c in value.rstrip("!?")) or stated and value.lower() != value and value.upper() != value
        if len(value) >= 6 and likely and guess_cost(value, words) >= least_cost:
            found.append((start, 3, stop))
    return found


def without_credentials(text: str, named: bool = True, digits: bool = True) -> str:
    """The text without its base spans and without the values of credential contexts."""
    spans = [(a, b) for a, _, b in base_spans(text, named, digits)]
    spans = sorted(spans + [(a, b) for a, b, _, _ in contexts(text)] if named else spans)
    kept, at = [], 0
    for a, b in spans:
        if a > at:
            kept.append(text[at:a])
        at = max(at, b)
    return " ".join([*kept, text[at:]])


def frequent_words(docs: DataFrame, text: str = "text", most: int = 20_000) -> list[str]:
    """The ``most`` frequent lower-case words of 3 to 24 letters over all documents, by falling frequency.

    Values of credentials don't count, so that a secret told often does not become a word of the dictionary.
    Counted in the tasks, summed by one aggregate; only this top list, a feature of the guesser's dictionary,
    reaches the driver.
    """
    letters = re.compile(r"[a-z]{3,24}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

        for batch in batches:
            for t, named, digits in marked(batch.column(0)):
                seen.update(letters.findall(without_credentials(t, named, digits)))
            if len(seen) > 100_000:
                yield out()
                seen.clear()
        yield out()

    counts = docs.select(docs[text].alias("_text")).mapInArrow(count, "word string, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "word").limit(most)
    return [r["word"] for r in top.collect()]


def word_costs(frequent: list[str]) -> dict[str, float]:
    """Cost of each word: the logarithm of its rank; the words people choose come first."""
    ranked = dict.fromkeys([*CHOSEN, *frequent])
    return {w: math.log10(k + 2) for k, w in enumerate(ranked)}


FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, "
    "found array<struct<kind:string,start:int,stop:int>>"
)


def find_secrets(docs: DataFrame, text: str = "text", least_cost: float = 9.0, dictionary: int = 20_000) -> DataFrame:
    """Per row: ``doc_id``, how many spans of each kind, and ``found``: (kind, start, stop) in code points.

    Whole texts are scanned in one pass. A null text counts as empty and has no spans; repeated rows stay; an
    empty table gives none; other columns are not read. A guessed value that lies wholly inside one base span adds
    nothing and is left out; one that reaches beyond it is told beside it.
    """
    costs = docs.sparkSession.sparkContext.broadcast(word_costs(frequent_words(docs, text, dictionary)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = costs.value
        for batch in batches:
            rows = []
            for doc_id, (t, named, digits) in zip(batch.column(0).to_pylist(), marked(batch.column(1))):
                spans = base_spans(t, named, digits)
                for g in guess_spans(t, words, least_cost) if named else ():
                    if not any(s[0] <= g[0] and g[2] <= s[2] for s in spans if s[1] < 3):
                        spans.append(g)
                spans.sort()
                n = Counter(s[1] for s in spans)
                named = [{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in spans]
                rows.append((doc_id, n[0], n[1], n[2], n[3], named))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "found"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text")).mapInArrow(scan, FOUND)


def secrets_digest(found: DataFrame) -> DataFrame:
    """``find_secrets`` with all spans as one text and the hash of the base spans, both in order of start and kind."""
    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("found", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"), "n_guess",
    )
