"""Operators on texts against brute force, held-out accuracy or exact round trips."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.common import bounded_sample
from llm import language_id, minhash_dedup, mixing, packing, quality_classifier, quality_rules, registry, token_counts, tokens
from tests.llm.conftest import DOCS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def test_language_id(spark, docs, empty):
    model = language_id.fit(docs.where("doc_id % 3 <> 1"))
    got = language_id.predict(docs.withColumn("score", F.lit("clash")), model).collect()
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 3 == 1 and r["doc_id"] < 160 and len(r["text"]) > 60]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        if not r["text"] or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
    assert language_id.fit(empty) is None and language_id.predict(empty, None).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}


def test_language_kernel_is_that_of_sets():
    seen = np.zeros(len(language_id.SIZES) << 16, dtype=bool)
    grams = []
    for t in ("Abc abd", "abd xyz"):
        language_id._flags(t, seen)
        b = t.lower().encode()
        grams.append({b[i : i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)})
        assert np.count_nonzero(seen) == len(grams[-1])


def test_nystroem_with_all_landmarks_is_the_exact_kernel(spark):
    """With every learned text a landmark, values are those of kernel ridge regression on the set kernel, written out here."""
    rng = random.Random(21)
    learn = [(i, prose(rng, lang, 12), lang) for i, lang in enumerate("en de fr".split() * 8)]
    ask = [prose(rng, lang, 9) for lang in "en de fr".split() * 4]
    model = language_id.fit(spark.createDataFrame(learn, "doc_id long, text string, lang string"), per_language=8, landmarks=8, ridge=0.05)
    assert model.langs == ["de", "en", "fr"] and len(model.marks) == 24
    seen = np.zeros(len(language_id.SIZES) << 16, dtype=bool)

    def grams(text):
        language_id._flags(text, seen)
        return set(np.flatnonzero(seen).tolist())

    kernel = lambda a, b: np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])
    sets, y = [grams(t) for _, t, _ in learn], np.array([[1.0 if lang == k else -1.0 for k in model.langs] for *_, lang in learn])
    exact = kernel([grams(t) for t in ask], sets) @ np.linalg.solve(kernel(sets, sets) / 8 + 0.05 * np.eye(24), y / 8)
    got = []
    for t in ask:
        language_id._flags(t, seen)
        got.append(model.values(seen[model.columns][None, :].astype(np.float32), np.array([float(seen.sum())]))[0])
    assert np.allclose(got, exact, atol=0.02)


def test_samples_are_bounded(spark):
    """A row repeated thousands of times counts once, and a draw never exceeds its bound."""
    rows = spark.createDataFrame([("en", f"text {i % 700}" if i % 3 else "the same") for i in range(9000)] + [("de", "ein"), ("de", "zwei")], "lang string, text string")
    got = bounded_sample(rows, "lang", F.xxhash64("text"), 50).collect()
    assert len([r for r in got if r["lang"] == "en"]) == 50 == len({r["text"] for r in got if r["lang"] == "en"}) and len(got) == 52
    labels = rows.select(F.lit(1).cast("long").alias("doc_id"), F.lit(1).alias("label")).union(spark.createDataFrame([(2, 0)], "doc_id long, label int"))
    model = quality_classifier.fit(spark.createDataFrame([(1, "good text")] * 500 + [(2, "BAD!!")], "doc_id long, text string"), labels)
    assert quality_classifier.predict(spark.createDataFrame([(3, "good text", 0)], "doc_id long, text string, score int"), model).columns == ["doc_id", "text", "score", "predicted"]


@pytest.mark.parametrize("n", [1, 5])
def test_repeated_and_long_texts_score_alike(spark, n):
    rows = spark.createDataFrame([(i % 3, "word " * (200_000 if i % 3 == 2 else 20), "x", "y") for i in range(3 * n)], "doc_id long, text string, text_ string, predicted string")
    model = quality_classifier.Model(np.ones(quality_classifier.TABLE), 0.0, 0.01, 0.0)
    got = quality_classifier.predict(rows, model).collect()
    assert len(got) == 3 * n and len({(r["doc_id"], r["score"]) for r in got}) == 3 and {r["text_"] for r in got} == {"x"}
    langs = language_id.predict(rows, language_id.fit(rows.withColumn("lang", F.lit("en")))).collect()
    assert {(r["lang_pred"], r["predicted"]) for r in langs} == {("en", "y")}


def test_quality_classifier(spark, empty):
    rng = random.Random(2)
    good = [prose(rng, rng.choice("en de fr es".split()), rng.randint(10, 80)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, "en", 30).split()) for _ in range(40)] + [" ".join([rng.choice(good).split()[0]] * 40) for _ in range(40)]
    rows = [(i, t, int(i < len(good))) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame([*rows, (900, None, 1), (901, "", 0), (902, "x", None)], "doc_id long, text string, label int")
    model = quality_classifier.fit(df.where("doc_id % 3 <> 1 and doc_id < 900").select("doc_id", "text"), df.where("doc_id % 3 <> 1").select("doc_id", "label"))
    got = quality_classifier.predict(df, model).collect()
    assert np.mean([(r["score"] >= 0.5) == bool(r["label"]) for r in got if r["doc_id"] % 3 == 1 and r["doc_id"] < 900]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got) and len(got) == len(rows) + 3
    none = quality_classifier.fit(df.limit(0), df.limit(0).select("doc_id", "label"))
    assert {r["score"] for r in quality_classifier.predict(df, none).collect()} == {0.5}
    assert quality_classifier.predict(df.limit(0), model).count() == 0


def test_coordinate_descent_finds_the_optimum():
    """The dual's solution has the value of a slow projected gradient solver of the same problem."""
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 12, 5)) for _ in range(30)]
    y, ratio, cost = rng.choice([-1.0, 1.0], 30), rng.normal(size=12), np.full(30, 0.7)
    w, b = quality_classifier.coordinate_descent(docs, y, ratio, cost, rounds=3000)
    x = np.zeros((30, 13))
    for row, d in zip(x, docs):
        row[d], row[12] = ratio[d], 1
    value = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    q, alpha = (x * y[:, None]) @ (x * y[:, None]).T, np.zeros(30)
    for _ in range(20_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / np.linalg.norm(q, 2), 0, cost)
    assert value(np.r_[w, b]) == pytest.approx(value((alpha * y) @ x), rel=2e-3)


def test_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    docs = [np.unique(rng.integers(0, 20, 6)) + (0 if i % 2 else 20) for i in range(60)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    w, b = quality_classifier.coordinate_descent(docs, y, np.ones(40), np.full(60, 1.0))
    assert all(np.sign(w[d].sum() + b) == k for d, k in zip(docs, y))


def reached(rows, width, percent):
    """Smallest id that links reach, by comparing all pairs."""
    sets, top = {}, {}
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        if r[0] is not None:
            sets.setdefault(r[0], s)
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: len(s) for i, s in sets.items()}, {i: root(i) for i in sets}


def test_sketch_loses_next_to_nothing():
    """Chance that a pair of similarity 0.8 lies too far apart by its sketch, and that it misses all tables."""
    from math import comb

    bits = minhash_dedup.SKETCH
    assert sum(comb(bits, k) * 0.1**k * 0.9 ** (bits - k) for k in range(minhash_dedup.FAR + 1, bits + 1)) < 3e-6
    miss = (1 - 0.8**minhash_dedup.HALF) ** minhash_dedup.TABLES
    assert 2 * miss - miss * miss < 8e-5


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_dedup(docs, rows, empty, width):
    got = minhash_dedup.near_duplicates(docs.withColumn("set", F.lit(1)).withColumn("n", F.lit("x")), width=width).collect()
    sizes, want = reached(rows, width, 80)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], want[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_sketches_differ_by_bits_whatever_their_sign():
    """Sketches two bits apart, the highest among them, are near; ones 64 bits apart are not, though the sets are equal."""
    whole = np.arange(50, dtype=np.uint64).tobytes()
    node = lambda i, s: {"id": i, "comp": i, "n": 50, "s": s, "t": 0, "set": whole}
    for other, want in ((-(2**63) + 1, [(1, 2)]), (-1, [])):
        found = []
        minhash_dedup._compare([node(1, 0)], [node(2, other)], 80, minhash_dedup.FAR, {}, found)
        assert found == want


def test_minhash_blocks(spark, monkeypatch):
    """Crowded tables and large components go through blocks; the result stays that of all pairs."""
    monkeypatch.setattr(minhash_dedup, "LARGE", 4)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 24)
    monkeypatch.setattr(minhash_dedup, "STEP", 8)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(70):
        share = rng.choice([0.01, 0.03, 0.06, 0.1])
        rows.append((i, " ".join(f"v{rng.randrange(10**6)}" if rng.random() < share else w for w in base), "en", "s", 0))
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), width=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == reached(rows, 2, 80)[1]


def test_quality_rules(docs, rows, empty, spark):
    got = quality_rules.apply(docs.withColumn("classes", F.lit(0)).withColumn("kept", F.lit(0))).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    extra = (300, "a b c d e f g h i j a b c d e f g h i j\nx y\n\nx y\n#% <|", "en", "s", 0)
    got += quality_rules.apply(spark.createDataFrame([extra], DOCS)).collect()
    for r in [*rows, extra]:
        t = r[1] or ""
        w = WORD.findall(t)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[r[0]].append((len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)))
    for r in got:
        base = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert base == want[r["doc_id"]][0]
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.apply(empty).count() == 0


def test_divergence_is_that_of_histograms(spark, docs):
    feats = quality_rules.features(docs).where("n_words >= 50 and lang is not null")
    refs = quality_rules.references(feats, 50, 200)
    listed = quality_rules._word_list()

    def distance(p, q):
        half = lambda a, b: sum(x * np.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
        return np.sqrt(max(0, (half(p, q) + half(q, p)) / 2))

    lang = sorted(refs)[0]
    chars, common = refs[lang]
    rest = 1 - sum(common.values())
    for r in feats.select("classes", "common", "word_chars", "n_words", quality_rules._char_distance(chars).alias("c"), quality_rules._word_distance(common).alias("w")).limit(20).collect():
        assert r["c"] == pytest.approx(distance([k / r["word_chars"] for k in r["classes"]], chars), abs=1e-9)
        p = [0.0] * len(listed)
        for x in r["common"]:
            p[x["k"]] = x["n"] / r["n_words"]
        assert r["w"] == pytest.approx(distance([*p, 1 - sum(p)], [*[common.get(k, 0.0) for k in range(len(listed))], rest]), abs=1e-6)


def test_word_salad_is_rejected(spark):
    """Texts without function words go, whatever language they claim; prose, and text of a language without a list, stays."""
    rng = random.Random(8)
    salad = lambda lang: " ".join(w if w not in quality_rules._word_list() else w + "x" for w in prose(rng, lang, 120).lower().rstrip(".").split())
    natural = lambda lang: " ".join(rng.choice(quality_rules.COMMON_WORDS[lang]) if rng.random() < 0.4 else w for w in salad(lang).split())
    good = [(i, natural(lang), lang, "s", 0) for i, lang in enumerate("en de fr es".split() * 15)]
    odd = [(100 + i, salad(lang), lang, "s", 0) for i, lang in enumerate("en de fr es".split())] + [(104, salad("en"), None, "s", 0), (105, salad("de"), "xx", "s", 0)]
    got = {r["doc_id"]: r for r in quality_rules.apply(spark.createDataFrame(good + odd, DOCS)).collect()}
    assert all(got[r[0]]["kept"] for r in good) and [got[r[0]]["kept"] for r in odd] == [False] * 5 + [True]
    assert not any(got[r[0]]["base_failed"] or got[r[0]]["char_distance"] > 0.3 for r in odd)
    feats = quality_rules.features(spark.createDataFrame(good + odd, DOCS))
    for _, words in quality_rules.references(feats, 50, 200).values():
        far = feats.where("doc_id = 104").select(quality_rules._word_distance(words).alias("w")).first()["w"]
        assert far == pytest.approx(quality_rules.empty_distance(words), abs=1e-9)
    assert all(r["kept"] for r in quality_rules.apply(spark.createDataFrame(odd[:1], DOCS)).collect())  # its own reference has no common words


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    """Queries against their SQL, on the smallest tables."""
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got, want = registry.QUERIES[name](spark, "/root/testdata/sf0.001"), con.execute(registry.ORACLE_SQL[name]).df()
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    cell = lambda v: None if v is None or v != v else round(v, 5) if isinstance(v, float) else v
    rows = lambda df: sorted((tuple(map(cell, r)) for r in df[names].itertuples(index=False, name=None)), key=repr)
    assert rows(got.toPandas()) == rows(want)


def test_rules_sql_on_odd_rows(spark, docs):
    extra = [(300, "x y\n\nx y\n#% <| É 12.", "en", "s", 0), (301, "Ab, cd! " * 40, None, "s", 0), (302, "ab 12 " * 99, "xx", "s", 0)]
    frame = docs.union(spark.createDataFrame(extra, DOCS))
    odd = frame.toArrow()  # noqa: F841
    want = duckdb.sql(quality_rules.ORACLE_SQL.replace("FROM documents", "FROM odd")).fetchall()
    cell = lambda v: round(round(v, 6), 5) if isinstance(v, float) else v
    assert sorted((tuple(map(cell, r)) for r in quality_rules.apply(frame).collect()), key=repr) == sorted((tuple(map(cell, r)) for r in want), key=repr)


def test_mixing(docs, rows, empty):
    frame = docs.withColumn("target", F.lit("clash"))
    first, again = mixing.assign(frame), mixing.assign(frame.repartition(7))
    key = lambda df: sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["shards"]) for r in df.collect()), key=repr)
    got = key(first)
    assert got == key(again) and len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    own = {s: sum(size(r[1]) for r in rows if r[3] == s) for s in sources}
    goal = dict(zip(sources, mixing.targets([own[s] for s in sources], [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5, 2.0)))
    assert sum(goal.values()) == pytest.approx(1.5 * sum(own.values()))
    taken = Counter()
    for r in first.collect():
        assert len(r["shards"]) <= 2 and r["size"] == size(r["text"])
        assert (r["source_size"], r["target"]) == (own[r["source"]], pytest.approx(goal[r["source"]]))
        taken[r["source"]] += r["size"] * len(r["shards"])
    for s in sources:  # below the target, and by less than the shortest document that could be taken once more
        unused = [r["size"] for r in first.collect() if r["source"] == s and r["size"] and len(r["shards"]) < min(2, int(goal[s] // own[s]) + 1)]
        assert 0 <= goal[s] - taken[s] < min([1, *unused] if not unused else unused) + 1e-6
    assert mixing.assign(empty).count() == 0 == mixing.mix(empty).count()


def test_mix_is_dealt_to_shards(spark, docs, rows, tmp_path):
    """Each copy lies in the shard that the tree gave it, and a partition in one shard; quotas of blocks are met in the output."""
    given = Counter()
    for r in mixing.assign(docs, shards=5, block_rows=4).collect():
        given.update((repr(r["doc_id"]), r["source"], s) for s in r["shards"])
    mixed = mixing.mix(docs.withColumn("_copy", F.lit(1)), shards=5, block_rows=4, part_rows=20)
    assert mixed.columns == [*docs.columns, "_copy", "shard"] and mixing.mix(docs, shard=None).columns == docs.columns
    got = mixed.withColumn("at", F.spark_partition_id()).collect()
    assert Counter((repr(r["doc_id"]), r["source"], r["shard"]) for r in got) == given
    where = defaultdict(set)
    for r in got:
        where[r["at"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values()) and len(where) > 5 and {r["shard"] for r in got} == set(range(5))
    many = Counter(r["shard"] for r in got)
    assert max(many.values()) - min(many.values()) <= 40
    mixing.write_mix(docs, str(tmp_path / "mix"), shards=5, block_rows=4)
    again = spark.read.parquet(str(tmp_path / "mix"))
    assert Counter(r["shard"] for r in again.select("shard").collect()) == many


def test_repeated_rows_move_together(spark):
    """A row repeated a thousand times is taken as one long document; its target is met within half of that."""
    rows = [(i, "one two three", "en", "a", 0) for i in range(50)] + [(7, "four five", "en", "a", 0)] * 1000 + [(100 + i, "six " * 9, "en", "b", 0) for i in range(900)]
    got = mixing.assign(spark.createDataFrame(rows, DOCS)).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["size"] * len(r["shards"])
    goal = {r["source"]: r["target"] for r in got}
    assert abs(taken["a"] - goal["a"]) <= 1000 and abs(taken["b"] - goal["b"]) <= 9
    assert len({len(r["shards"]) for r in got if r["doc_id"] == 7 and r["size"] == 2}) == 1


def test_mixing_fills(spark):
    """A long document that doesn't fit is passed over, in small ranges of hashes as well as in one."""
    rng = random.Random(9)
    rows = [(i, "w " * (20_000 if i % 97 == 0 else rng.randint(1, 60)), "en", f"s{i % 2}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    for fill in (16, 512):
        got = mixing.assign(df, share=0.4, block_rows=32, fill=fill).collect()
        for s in ("s0", "s1"):
            mine = [r for r in got if r["source"] == s]
            left = mine[0]["target"] - sum(r["size"] * len(r["shards"]) for r in mine)
            unused = [r["size"] for r in mine if not r["shards"]]
            assert 0 <= left < max(1, min(unused)) and max(len(r["shards"]) for r in mine) == 1


@pytest.mark.parametrize("quotas", [[0, 0], [5], [100, 3, 0, 41], [1, 1, 1]])
def test_splitting_tree_keeps_quotas(quotas):
    out = mixing.split_quotas(quotas, 7, 1)
    assert [sum(x) for x in zip(*out)] == quotas and max(map(sum, out)) - min(map(sum, out)) <= 3


def test_targets_with_caps():
    assert mixing.targets([10, 100, 0], [3, 1, 2], 1.5, 2) == pytest.approx([20, 145, 0])
    assert mixing.targets([], [], 1.5, 2) == []


def plain_first_fit(sizes, room):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = next((k for k, b in enumerate(bins) if sum(sizes[j] for j in b) + sizes[i] <= room), None)
        bins.append([i]) if k is None else bins[k].append(i)
    return bins


def test_tournament_tree_is_first_fit():
    rng = random.Random(4)
    for n in (0, 1, 2, 17, 100):
        sizes = [rng.randint(1, 50) for _ in range(n)]
        assert packing.first_fit_decreasing(sizes, 50) == plain_first_fit(sizes, 50)
        got = packing.pack(sizes, 50)
        assert sum(sum(p[2] for p in b) < 50 for b in got) <= 1
        parts = sorted(p for b in got for p in b)
        assert all(sum(p[2] for p in parts if p[0] == i) == sizes[i] for i in range(n))


def test_packing_keeps_ids(spark):
    """Ids beyond 2**53 beside a null one."""
    rows = [(2**60 + 1, "one two", None, None, 0), (None, "three", None, None, 0), (2**60 + 3, "four " * 3000, None, None, 0), (None, None, None, None, 0)]
    got = packing.pack_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"] for r in got} == {2**60 + 1, 2**60 + 3, None}
    assert sum(r["length"] for r in got if r["doc_id"] == 2**60 + 3) == next(r["doc_tokens"] for r in got if r["doc_id"] == 2**60 + 3) > 1024


def test_packing_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer

    import public_tokenizers

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs, length=128, group_docs=64).collect()
    ids = {r[0]: np.array([*bpe.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4") for r in rows}
    copies, found, sequences = Counter(r[0] for r in rows), Counter(), defaultdict(list)
    for r in got:
        x = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(x) and r["ids_crc32"] == zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes())
        found.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == Counter({(d, k): n for d, n in copies.items() for k in range(len(ids[d]))})
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack_documents(empty).count() == 0


def test_pieces_cross_no_pretoken(monkeypatch):
    """Ids are those of the vocabulary's own tokenizer, its added token included, wherever long texts are cut."""
    from tokenizers import Tokenizer

    import public_tokenizers

    monkeypatch.setattr(tokens, "STEP", 6)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc, rng = tokens.encoder(tokens.default_path()), random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice(["a", "B", "é", "1", " ", "  ", "\n", "\t", "'s", "'", ".", " ", " ", "日", "\x1c", "<|endoftext|>"]) for _ in range(rng.randint(0, 40)))
        assert enc.ids(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() and enc.count(t) == len(enc.ids(t)) // 4


def test_token_counts_follow_edits(spark, docs, rows, empty):
    enc = tokens.encoder(tokens.default_path())
    count = lambda t: enc.count(t or "")
    state = token_counts.build(docs.withColumn("counts", F.lit("clash")).withColumn("n_encoded", F.lit("clash")))
    edits = spark.createDataFrame([(3, 2, 5, 3, "new words "), (3, 1, 0, 0, "First "), (206, 1, 90_000, 400, " \n"), (206, 2, -5, 10**9, None), (201, 1, 4, 1, "text"), (200, 1, 0, 0, "was null")], "doc_id long, seq long, start long, removed long, inserted string")
    got = token_counts.apply_edits(token_counts.attach(state, edits)).collect()
    assert len(got) == len(rows) and all(r["n_tokens"] == count(r["text"]) for r in got)
    text = next(r["text"] for r in got if r["doc_id"] == 3)
    was = "First " + rows[3][1]
    assert text == was[:5] + "new words " + was[8:]
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (200, 201, 206)} == {200: "was null", 201: "text", 206: ""}
    assert token_counts.apply_edits(token_counts.attach(token_counts.build(empty), edits)).count() == 0


def test_edits_touch_little():
    enc, rng = tokens.encoder(tokens.default_path()), random.Random(7)
    text = prose(rng, "en", 20_000)
    tree = token_counts.Tree.build(text, enc)
    for _ in range(60):
        a, gone, new = rng.randint(0, len(text)), rng.choice([0, 1, 5, 700]), rng.choice(["", " ", "\n x", "word", " two words ", prose(rng, "de", 300)])
        text, again = tree.edit(text, a, gone, new, enc)
        assert again < len(new) + 8 * token_counts.LEAF
        assert tree.counts[1] == enc.count(text) and tree.chars[1] == len(text)


@pytest.mark.parametrize("parts", [["日", "本", "語", "。", "、"], ["abc", "12", "-", ":x", "Q"]])
def test_texts_without_spaces_have_leaves(parts):
    enc, rng = tokens.encoder(tokens.default_path()), random.Random(12)
    text = "".join(rng.choice(parts) for _ in range(60_000))
    tree = token_counts.Tree.build(text, enc)
    new, again = tree.edit(text, 30_000, 3, parts[0] * 5, enc)
    assert again < 8 * token_counts.LEAF and tree.counts[1] == enc.count(new)


def test_cuts_follow_any_edit(monkeypatch):
    """Small leaves, edits of all kinds next to their borders, and the added token made and broken by edits."""
    monkeypatch.setattr(token_counts, "LEAF", 8)
    enc, rng = tokens.encoder(tokens.default_path()), random.Random(13)
    bits = ["a", "B", "é", "1", " ", "  ", "\n", "'s", "'", ".", "-", "日", "。", "<|endoftext|>", "<|", "endoftext", "|>", "12", "abc"]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 120)))
        tree = token_counts.Tree.build(text, enc)
        for _ in range(8):
            text, _ = tree.edit(text, rng.randint(-2, len(text) + 2), rng.choice([0, 0, 1, 5, 30]), "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 40]))), enc)
            assert tree.counts[1] == enc.count(text) and tree.chars[1] == len(text)
