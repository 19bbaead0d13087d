import re
from collections import Counter

import public_tokenizers
from test_line_dedup import brute as brute_lines
from test_ngram_join import brute as brute_groups
from test_packing import library

import corpus_pipeline as cp

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def test_each_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120)
    assert [name for name, _ in cp.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    (_, toxicity), (_, lines), (_, join), (_, mix), (_, pack) = cp.STAGES
    rows = {r.doc_id: r for r in docs.collect()}

    clean = toxicity(spark, docs, FOLDER).cache()
    assert clean.columns == list(cp.COLUMNS) and all(rows[r.doc_id] == r for r in clean.collect())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert all(k in kept for k in rows if labels.get(k) == 0)

    short = clean.filter("n_chars < 3000").cache()
    deduped = lines(spark, short, FOLDER).cache()
    texts = {r.doc_id: r.text for r in short.collect()}
    want = {k: t for k, t in brute_lines(list(texts.items())).items() if t == texts[k] or WORD.search(t)}
    assert {r.doc_id: r.text for r in deduped.collect()} == want
    assert all(r.n_chars == len(r.text) for r in deduped.collect())

    unique = join(spark, deduped, FOLDER).cache()
    groups = brute_groups([(r.doc_id, r.text) for r in deduped.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == sorted({low for _, _, low in groups})

    mixed = mix(spark, unique, FOLDER).cache()
    assert mixed.columns == list(cp.COLUMNS) and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    ids = Counter()
    for r in pack(spark, mixed, FOLDER).collect():
        ids[r.doc_id] += r.length
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id] += len(library([r.text])[0]) + 1
    assert ids == want and public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_without_ids_and_repeated_ones(spark):
    """Nulls in every column, a repeated row, one id with two texts, near copies without ids, and a further column that clashes with helpers."""
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(None, long, "en", "s", 9), (None, None, None, None, None), (5, long, "en", "s", 9), (5, long, "en", "s", 9), (5, other, "en", "s", 9), (7, long + " end", "de", "t", 9), (8, "", "de", "t", 0), (8, "", "de", "t", 0)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, __row string")
    stages = dict(cp.STAGES)
    clean = stages["toxicity"](spark, docs, FOLDER)
    assert rows_of(clean) == sorted(rows, key=str) and clean.columns == list(cp.COLUMNS)
    lined = stages["line_dedup"](spark, docs, FOLDER)
    # the null id comes first, so that its line stays; the others of its group lose theirs and go, as they had no other
    assert rows_of(lined) == sorted([rows[0], rows[1], rows[4], rows[6], rows[7]], key=str)
    unique = stages["ngram_join"](spark, docs, FOLDER)
    assert rows_of(unique) == sorted([rows[1], rows[2], rows[4], rows[6], rows[7]], key=str)
    assert set(rows_of(stages["mixing"](spark, docs, FOLDER))) <= set(rows)
    assert sorted({r.doc_id for r in stages["packing"](spark, docs, FOLDER).collect()}, key=str) == [5, 7, 8, None]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
