"""Each stage of the pipeline on odd input and against brute force, and the whole of it."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from llm import language_id, mixing, pii, tokens
from llm.common import held_out
from tests.llm.conftest import DOCS, prose
from tests.llm.test_texts import WORD, reached

CLASHES = {"lang_pred": "a", "score": 1, "row_": "b", "component_id": 2, "n_entities": 3, "kinds": "c", "size": "d", "shards": 4, "target": 5, "_copy": "e", "g": 6, "id": 7, "many": 8}


OTHERS = "Lang_Pred Score ROW_ Component_Id N_Entities Kinds Size Shards Target Source_Size _sid _nb _block _copies _edge _cut _h _u _key _shard _copy _row _more _part _parts c0 c1 G Start Length".split()


@pytest.fixture(scope="module")
def odd(spark, rows):
    """The odd rows with personal data, more repeated rows, shared ids and rows without an id, and columns with clashing names."""
    rng = random.Random(31)
    one, two = prose(rng, "en", 60), prose(rng, "de", 60)
    more = [(None, one, "en", "s1", 1), (None, one, "en", "s1", 1), (500, one, "en", "s1", 1), (500, two, "de", "s1", 1), (500, two, "de", "s1", 1), (501, two + " x", "de", None, 1)]
    more += [(502, "Mail to eve@mail.example.com, Mrs. Eva Stone. Stone left.", "en", "s2", 1), (503, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    out = spark.createDataFrame([*rows, *more], DOCS)
    return [*rows, *more], out.withColumns({k: F.lit(v) for k, v in CLASHES.items()})


def key(df_or_rows):
    rows = df_or_rows.collect() if hasattr(df_or_rows, "collect") else df_or_rows
    return Counter((r[0], r[1], r[2], r[3]) for r in rows)


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_stages_keep_columns_and_take_empty_tables(spark, odd, empty, name, stage):
    got = stage(spark, odd[1], "")
    assert got.columns == odd[1].columns
    for r in got.collect():
        assert {k: r[k] for k in CLASHES} == CLASHES
    none = stage(spark, empty, "")
    assert none.columns == empty.columns and none.count() == 0


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_take_any_names(spark, odd, name, stage):
    """Names of other case than the operators', or like those inside them, with values that come through as they are."""
    df = odd[1].drop("n_chars", *CLASHES).withColumns({c: F.lit(f"mine {i}") for i, c in enumerate(OTHERS)})
    got = stage(spark, df, "")
    if stage is not pipeline.pack_sequences:
        assert got.columns == df.columns
        for r in got.collect():
            assert [r[c] for c in OTHERS] == [f"mine {i}" for i in range(len(OTHERS))]
    plain = stage(spark, odd[1], "")
    assert got.select("doc_id").exceptAll(plain.select("doc_id")).count() == 0 == plain.select("doc_id").exceptAll(got.select("doc_id")).count()


def test_languages(spark, odd):
    rows, df = odd
    letters = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    assert key(pipeline.keep_languages(spark, df, "")) == key(letters)
    unknown = df.withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.keep_languages(spark, unknown, "").count() == len(rows)
    model = language_id.fit(df.where(~held_out(F.col("doc_id"))))
    assert model.langs == ["de", "en", "es", "fr"]


def test_short_documents_stay(spark, docs, rows):
    """One word is enough to stay; only what has no letters goes."""
    short = [(1000 + i, t, None, "s0", 0) for i, t in enumerate(["Avec.", "De.", "Re.", "a", "Qwkz", "Mentmentan.", "12 !!", "", None])]
    got = pipeline.keep_languages(spark, docs.union(spark.createDataFrame(short, DOCS)), "")
    assert key(got) == key([r for r in [*rows, *short] if r[1] and any(map(str.isalpha, r[1]))])


def test_near_duplicates(spark, odd):
    rows, df = odd
    _, top = reached([(i, r[1]) for i, r in enumerate(rows)], 5, 80)
    best = {}
    for i in sorted(top, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        best.setdefault(top[i], i)
    want = [rows[i] for i in range(len(rows)) if best[top[i]] == i or not WORD.search(rows[i][1] or "")]
    got = pipeline.drop_near_duplicates(spark, df.repartition(3), "")
    assert key(got) == key(want) and Counter(r["doc_id"] for r in got.collect())[500] == 2


def test_personal_data(spark, odd):
    rows, df = odd
    got = pipeline.replace_personal_data(spark, df, "").collect()
    assert len(got) == len(rows) and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    clean = [r for r in rows if not pii.entities(r[1] or "")]
    assert key([r for r in got if r["doc_id"] != 502]) == key(clean)
    text = next(r["text"] for r in got if r["doc_id"] == 502)
    assert "eve@" not in text and "Stone" not in text and "Eva" not in text and text.startswith("Mail to ") and text.endswith(" left.")


def test_mixing(spark, odd):
    rows, df = odd
    want = Counter()
    plan = mixing.assign(spark.createDataFrame(rows, DOCS)).collect()
    for r in plan:
        want[r["doc_id"], r["text"], r["lang"], r["source"]] += len(r["shards"])
    assert key(pipeline.mix_sources(spark, df, "")) == +want
    for s in {r["source"] for r in plan}:
        mine = [r for r in plan if r["source"] == s]
        assert abs(sum(r["size"] * len(r["shards"]) for r in mine) - mine[0]["target"]) <= 2 * max(r["size"] for r in mine)


def test_packing(spark, odd):
    rows, df = odd
    got, enc = pipeline.pack_sequences(spark, df, "").collect(), tokens.encoder(tokens.default_path())
    many = Counter()
    for r in rows:
        many[r[0]] += enc.count(r[1] or "") + 1
    found = Counter()
    for r in got:
        found[r["doc_id"]] += r["length"]
    assert found == many and all(r["offset"] + r["length"] <= 1024 for r in got)


def test_whole(spark, odd, tmp_path):
    rows, _ = odd
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
    count = lambda df: sum(r["length"] for r in df.select("length").collect())
    assert got.columns == docs.columns and count(got) == count(docs) > 0


def test_empty(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
