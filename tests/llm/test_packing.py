import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from siftlode.llm.byte_bpe import encoder
from siftlode.llm.packing import pack_documents, pack_examples

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def ours(texts):
    raw = [t.encode() for t in texts]
    ids, sizes = encoder(PATH).encode(b"".join(raw), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))
    cuts = np.cumsum(sizes)[:-1]
    return [x.tolist() for x in np.split(ids, cuts)]


TRICKY = ["", " ", "a", "'s", "it's we'll they're I'd 'm", " 'tis ''s x''s 'S", "a  b\n\n c\t\td \n", "  lead", "trail  ", "x y　 z", "12ab 3½ Ⅷ", "<|endoftext|> x", "hello <|endoftext|> world", "a<|endoftext|><|endoftext|>", "é à ß Ñ 漢字 かな 한국", "😀 a😀b ...!! --", "'" , "'r", "'ree", "\r\n'll'll", "a͸b c's", "'s't", "  x", "a'ſb"]


def test_ids_equal_the_library(spark):
    rng = random.Random(5)
    parts = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "Bc", "é", "1", "½", ".", "!!", "漢", " ", "'d"]
    texts = TRICKY + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    assert ours(texts) == library(texts)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert ours(docs) == library(docs)


def check(spark, rows, **options):
    df = spark.createDataFrame([(k, t, "e") for k, t in rows], "doc_id long, text string, ids string").repartition(2)
    got = pack_documents(df, PATH, with_ids=True, **options).collect()
    docs, bins = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
        assert r.length == len(r.ids) > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for (key, _), ids in zip(rows, library(t or "" for _, t in rows), strict=True):
        pieces = sorted(docs[key], key=lambda r: r.start)
        assert [i for r in pieces for i in r.ids] == [*ids, 0]
        assert all(r.doc_tokens == len(ids) + 1 for r in pieces)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
    padding = 0
    for pieces in bins.values():
        pieces.sort(key=lambda r: r.offset)
        total = 0
        for r in pieces:
            assert r.offset == total
            total += r.length
        assert total <= 1024 and len(pieces) <= options.get("segments", 128)
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    return padding, sum(r.length for r in got)


def test_documents(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "of", "xyz", "é!"]) for _ in range(rng.choice([0, 1, 5, 300, 1023, 5000])))) for i in range(150)]
    padding, total = check(spark, [*rows, (900, None), (901, ""), (902, "word " * 60_000)])
    assert padding == 0 < total
    check(spark, rows, segments=3)
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_examples(spark):
    rng = random.Random(2)
    rows = [(i, n := rng.randint(0, 500), rng.randint(0, n)) for i in range(400)] + [(1000, 2000, 5), (1001, None, None)]
    got = pack_examples(spark.createDataFrame(rows, "example_id long, tokens long, loss_tokens long"), segments=8, loss=600).collect()
    assert sorted(r.example_id for r in got) == sorted(r[0] for r in rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    for b in bins.values():
        if len(b) > 1:
            assert sum(r.tokens for r in b) <= 1024 and sum(r.loss_tokens for r in b) <= 600 and len(b) <= 8
    assert len(bins) < 1.25 * sum(r[1] or 0 for r in rows) / 1024 + 20
