"""Ids of the parts of texts against the tokenizer on whole texts."""

import random
from struct import unpack

from tokenizers import Tokenizer

from tickloom.llm import packing

BITS = ["'", "s", "'s", "'RE", "re", "'ll", "L", "A", "é", "É", "ß", "×", "÷", "ÿ", "1", "23", "-", "<", "|", "<|endoftext|>", "<|EndOfText|>", "|>",
        " ", "\n", "\t", "\x0b", "\x1c", "\x00", " ", " ", "İ", "ﬁ", "日本", "é", "́", "²", "🙂", ",", "!?", "don't", "_", "µ"]


def test_parts_give_the_ids_of_whole_texts(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 1_000_000)
    rng = random.Random(2)
    texts = [None, "", *("".join(rng.choices(BITS, k=rng.randrange(40))) for _ in range(6000)), "ß" * 5000, "x" * 100_000]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    whole, tokens = Tokenizer.from_file(packing.TOKENIZER), packing.PartTokens(packing.TOKENIZER)
    for at in range(0, len(texts), 256):
        batch = texts[at:at + 256]
        parts = [tokens.parts(t) for t in batch]
        tokens.learn(parts)
        assert tokens.held < 50_000_000
        for one, want in zip(parts, whole.encode_batch_fast([t or "" for t in batch], add_special_tokens=False), strict=True):
            ids = tokens.ids(one)
            assert list(unpack(f"<{len(ids) // 4}I", ids)) == [*want.ids, packing.END_ID]
