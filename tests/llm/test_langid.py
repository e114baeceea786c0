import random
import zlib

from pyspark.sql import functions as F

from labelloom.llm import langid

ALPHABETS = {"aa": "abcdefg", "bb": "defghij", "cc": "éèàçxyz"}


def corpus(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(sorted(ALPHABETS))
        words = ["".join(draw.choices(ALPHABETS[lang], k=draw.randrange(2, 8))) for _ in range(draw.randrange(5, 40))]
        rows.append((i, " ".join(words), lang if i % 7 else None, lang))
    return rows


def test_held_out_accuracy_and_calibration(spark):
    rows = corpus(600)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, truth string")
    got = langid.language(docs).join(docs.select("doc_id", "truth"), "doc_id").where("held_out").collect()
    right = [r.lang_pred == r.truth for r in got]
    assert len(got) > 100 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in got)
    assert abs(sum(r.score for r in got) / len(got) - sum(right) / len(right)) < 0.08


def test_language_and_held_out_rows_do_not_reach_the_model(spark):
    docs = spark.createDataFrame(corpus(300), "doc_id bigint, text string, lang string, truth string")
    flipped = docs.rdd.map(lambda r: (r.doc_id, r.text, "zz" if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.lang)).toDF("doc_id long, text string, lang string")
    one, two = (sorted(langid.language(x).collect()) for x in (docs, flipped))
    assert one == two and "zz" not in {r.lang_pred for r in one}


def test_the_sample_is_bounded_whatever_id_is_repeated(spark, monkeypatch):
    from labelloom.llm.shared import ROW

    monkeypatch.setattr(langid, "FIT_ROWS", 60)
    rows = [(7, "repeated text", "aa")] * 3000 + [(7, "another", "bb")] + [(i, f"text {i}", "ab"[i % 2] * 2) for i in range(1000)]
    texts = spark.createDataFrame(rows, "id long, body string, lang string").withColumn(ROW, F.monotonically_increasing_id())
    sizes = {r.lang: r["count"] for r in texts.groupBy("lang").agg(F.approx_count_distinct("id").alias("count")).collect()}
    drawn = langid.sample_of(texts, sizes).collect()
    assert len({r[ROW] for r in drawn}) == len(drawn) == 60
    assert all(sum(r.lang == lang for r in drawn) == 30 for lang in ("aa", "bb"))


def test_odd_input(spark, odd, empty):
    rows = langid.language(odd).collect()
    assert len(rows) == 11
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"} and {r.score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert {r.lang_pred for r in rows if r.doc_id not in (3, 4, 5)} <= {"en", "de"}
    assert langid.language(empty).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in langid.language(unlabelled).collect()} == {("und", 0.0)}


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(4).choices("abcé中🙂 ", k=500))
    whole = langid.counts(text)
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(langid, "BLOCK_CHARS", size)
        assert (langid.counts(text) == whole).all()
    assert whole.sum() == 500 + 499 + 498


def test_elastic_net_makes_weights_sparse(monkeypatch):
    idf = langid.np.ones(langid.FEATURES)
    names = sorted(ALPHABETS)
    rows = [(*langid.weighted(text, idf), names.index(lang)) for _, text, _, lang in corpus(60)]
    used = []
    for strength in (0.0, 3.0):
        monkeypatch.setattr(langid, "L1", strength)
        used.append((langid.follow_the_leader(rows, 3) != 0).sum())
    assert 0 < used[1] < 0.1 * used[0]
