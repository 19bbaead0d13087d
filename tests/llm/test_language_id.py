import random

import numpy as np

from siftlode.llm import language_id as li
from siftlode.llm import registry

WORDS = {"en": "the of and house green water thing with", "de": "der und haus grün wasser ding mit schön", "fr": "le et maison vert eau chose avec été"}


def documents(n, seed=1):
    rng = random.Random(seed)
    langs = list(WORDS)
    return [(i, " ".join(rng.choice(WORDS[lang := langs[i % 3]].split()) for _ in range(rng.randint(3, 40))), lang) for i in range(n)]


def subwords(text):
    """Rows of a text's words and grams, one by one."""
    out, word = [], bytearray()
    for b in [*text.encode(), 32]:
        if li._LETTER[b]:
            word.append(li.tv.LOWER[b])
        elif word:
            whole = np.frombuffer(bytes(word), np.uint8)
            out.append(int(li.tv.hashes(whole, np.array([0]), np.array([len(whole)]))[0]) & (li.ROWS - 1))
            padded = b" " + bytes(word) + b" "
            for n in li.GRAMS:
                for i in range(len(padded) - n + 1):
                    out.append(li.tv.mix1(int.from_bytes(padded[i : i + n], "little") | n << 40) & (li.ROWS - 1))
            word = bytearray()
    return sorted(out)


def test_subwords_one_by_one():
    texts = ["", "Der, Hund. a", "é", "x1y--zz", "  ", "abcde", "I"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    owner, rows = li._subwords(data, offsets)
    for k, t in enumerate(texts):
        assert sorted(rows[owner == k].tolist()) == subwords(t)


def test_gradient_steps_lower_the_loss_and_folding_is_exact():
    docs = documents(120)
    texts = [(np.array(sorted(set(subwords(t)))), None) for _, t, _ in docs]
    texts = [(r, np.full(len(r), 1 / len(r))) for r, _ in texts]
    model = li.fit(texts, [x for *_, x in docs])
    p = np.array([li._softmax((s @ model.table[r] + model.bias) / model.temperature) for r, s in texts])
    assert model.names == ["de", "en", "fr"] and (p.argmax(1) == [model.names.index(x) for *_, x in docs]).mean() > 0.97


def test_temperature_and_rejection():
    rng = np.random.default_rng(0)
    true = rng.normal(0, 2, (4000, 3))
    y = np.array([rng.choice(3, p=li._softmax(x)) for x in true])
    assert 2.5 < li.temperature(true * 3, y) < 3.6
    score, right = np.array([0.9, 0.9, 0.8, 0.7, 0.6]), np.array([True, True, True, False, True])
    assert li.rejection(score, right, 0.0) == 0.8 and li.rejection(score, right, 0.2) == 0.6
    assert li.rejection(np.array([0.9, 0.9]), np.array([True, False]), 0.1) > 1


def test_held_out_languages(spark):
    docs = [(*r, 1.0) for r in documents(400)]
    odd = [(None, docs[0][1], "en", 1.0), (1000, None, "en", 1.0), (1001, "", "de", 1.0), (1002, "12 + 3!", "fr", 1.0), (1003, "der und " * 200_000, None, 1.0), (7, docs[7][1], docs[7][2], 1.0), (1004, "١ ж", None, 1.0)]
    df = spark.createDataFrame([*docs, *odd], "doc_id long, text string, lang string, score double")
    got = li.languages(df).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in got)
    truth = {r[0]: r[2] for r in docs}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 60 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    by = {r.doc_id: r for r in got}
    assert [(by[k].lang_pred, by[k].rejected) for k in (1000, 1001, 1002)] == [("und", True)] * 3
    assert by[1003].lang_pred == "de" and by[1004].lang_pred in WORDS and by[None].held_out is False
    again = {(r.doc_id, r.lang_pred, r.score) for r in li.languages(df.repartition(3)).collect()}
    assert again == {(r.doc_id, r.lang_pred, r.score) for r in got}


def test_without_languages(spark):
    df = spark.createDataFrame([(1, "hello", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r.lang_pred) for r in li.languages(df).orderBy("doc_id").collect()] == ["und", "und"]
    assert li.languages(df.limit(0)).collect() == []


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in registry.queries()["op13_language_id"](spark, folder).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
