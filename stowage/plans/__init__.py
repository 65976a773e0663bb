"""The analyses, from cleaning to billing, inventory level and labour margin."""
