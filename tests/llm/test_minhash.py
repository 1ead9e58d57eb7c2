"""MinHash near-duplicates against brute force; signatures; groups that stars alone would not join."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from frameloom.llm import common, entries, jaccard, minhash  # noqa: E402

DOCS = "doc_id long, text string"


def _found(df):
    return sorted(tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in df.collect())


def test_near_duplicates(spark, tiny):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    got = entries.op11_minhash(spark, tiny)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert _found(got) == sorted(brute.near(docs, 2, 80))
    assert {r["doc_id"] for r in got.where("kept").collect()} == {i for i, _, c in brute.near(docs, 2, 80) if i == c}


@pytest.mark.parametrize("size", [1, 3, 12, 60, 500])
def test_signatures_agree_with_the_similarity(size):
    rng, signer = np.random.default_rng(size), minhash.Signer(60, 5)
    agree, total = 0, 0
    for _ in range(200 if size < 100 else 40):
        shared, own = rng.integers(0, 1 << 63, 4 * size, dtype=np.uint64) * np.uint64(2), rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(np.concatenate((shared, own[:size]))), np.unique(np.concatenate((shared, own[size:])))
        agree, total = agree + (signer.signature(a) == signer.signature(b)).sum(), total + signer.bins
    # 4 of 6 shingles are shared
    assert agree / total == pytest.approx(4 / 6, abs=0.03)


def test_odd_documents(spark):
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "A"), (5, "a b"), (6, "b a"), (7, "x " * 30_000), (8, "X x x"), (None, "a b"), (None, None), (9, "é" * 3000), (10, "é" * 3000 + " end")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], DOCS + ", bands int, component_id string")
    got = minhash.near_duplicates(df)
    assert got.count() == len(rows) and got.where("doc_id is null").select("component_id", "kept").distinct().collect() == [(None, True)]
    want = sorted(brute.near([r for r in rows if r[0] is not None], 2, 80))
    assert _found(got.where("doc_id is not null")) == want
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    # rows of one doc_id are one node, even of different texts
    twice = spark.createDataFrame([(1, "a b c"), (1, "d e f"), (2, "d e f"), (0, "a b c"), (5, "a b c"), (5, "a b c")], DOCS)
    assert _found(minhash.near_duplicates(twice)) == [(0, 2, 0), (1, 2, 0), (1, 2, 0), (2, 2, 0), (5, 2, 0), (5, 2, 0)]


def groups():
    """Documents around a passage that all share: chains in which only neighbours are linked, and many that are equally far apart."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdefgh", k=8))
    passage, docs = [word() for _ in range(60)], []
    for _ in range(8):
        own = [word() for _ in range(60)]
        for _ in range(20):
            docs.append(" ".join(passage + own))
            for _ in range(4):
                own[rnd.randrange(len(own))] = word()
    docs += [" ".join(passage + [word() for _ in range(12)]) for _ in range(150)]
    docs += [" ".join(passage[:55] + [word() for _ in range(rnd.randrange(1, 6))]) for _ in range(150)]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def test_groups_that_are_not_stars(spark):
    docs = groups()
    df = spark.createDataFrame(docs, DOCS)
    assert _found(minhash.near_duplicates(df)) == sorted(brute.near(docs, 2, 80))


def test_links_of_few_and_many_members_are_found_without_their_centres(spark, monkeypatch):
    docs = groups()[:220]
    df = spark.createDataFrame(docs, DOCS)
    monkeypatch.setattr(minhash, "FAN", 1)
    # low bands put unlinked documents into one bucket, so that all goes through the groups' exact join
    assert _found(minhash.near_duplicates(df, bands=12, rows=1)) == sorted(brute.near(docs, 2, 80))
    monkeypatch.setattr(minhash, "FAN", 1000)
    assert _found(minhash.near_duplicates(df, bands=12, rows=1)) == sorted(brute.near(docs, 2, 80))


def test_members_that_are_equally_far_apart_end_the_levels(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefgh", k=9))
    core = [word() for _ in range(80)]
    docs = [(i, " ".join(core + [word() for _ in range(22)])) for i in range(120)]
    df = spark.createDataFrame(docs + [(500, docs[3][1] + " end")], DOCS)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()}
    assert got == {i: i for i, _ in docs} | {500: 3}


def test_near_copies_with_many_differences_make_few_comparisons(spark, monkeypatch):
    """members of one group are compared at their rarest differences, and only where a link's overlap still fits."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=3)) for _ in range(400)]
    base, docs = [rnd.choice(words) for _ in range(150)], []
    for i in range(600):
        own = list(base)
        for _ in range(rnd.randrange(15, 25)):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        docs.append((i, " ".join(own)))
    # chains around the same text: links of the ends are not the core's
    for i in range(60):
        own = docs[-1][1].split()
        own[i], own[i + 60] = f"x{i // 3}", f"y{i}"
        docs.append((600 + i, " ".join(own)))
    compared, plain = [], jaccard.pairs_of

    def pairs_of(rows, unit):
        sides = rows.groupBy("token").agg(F.count_if("long").alias("l"), F.count_if("short").alias("s"))
        compared.append(sides.agg(F.coalesce(F.sum(F.col("l") * F.col("s")), F.lit(0))).first()[0])
        return plain(rows, unit)

    monkeypatch.setattr(jaccard, "pairs_of", pairs_of)
    df = spark.createDataFrame(docs, DOCS)
    sets = jaccard.cut_sets(df, spark.sparkContext.broadcast(np.zeros(2, dtype=np.uint8)), df.select("doc_id"), 2)
    links, pairs = jaccard.group_links(df.selectExpr("0 as gid", "doc_id as doc"), sets, 80)
    pairs = common.written(common.union(*pairs).distinct(), "pairs")
    links.append(jaccard.similar_whole(pairs, sets, 80))
    found = {r["node"]: r["component"] for r in common.components(common.union(*links)).collect()}
    assert [(i, found.get(i, i)) for i, _ in docs] == [(i, c) for i, _, c in sorted(brute.near(docs, 2, 80))]
    # in the order of a fixed sketch, 54,434 comparisons left 2788 candidates
    assert sum(compared) < 40_000 and pairs.count() < 1500


def test_hot_groups_are_salted_alike(spark, monkeypatch):
    from frameloom.llm import common

    docs = [(i, f"{i // 40 % 2} and some more words that all of them say again and again") for i in range(2500)]
    hot = common.hot_rows(spark.createDataFrame([(i % 2, 1) for i in range(4000)], "k int, x int"), "k")
    assert sorted(r["_hot"] for r in hot.collect()) == [0, 1]
    assert {r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()} <= {0, 40}


def test_tables_between_steps_go(spark, tmp_path):
    """what a step leaves in the shared folder, or as shuffle files, is gone when nothing reads it any more."""
    from frameloom.llm import common, jaccard, minhash

    text = "sha2(cast(id div 2 as string), 512)"
    docs = spark.range(400).selectExpr("id as doc_id", f"concat_ws(' ', transform(sequence(1, 60), i -> substring({text}, i, 4)), id % 2) as text")
    for made in (jaccard.jaccard_components(docs), minhash.near_duplicates(docs)):
        assert made.where("component_id < doc_id").count() == 200
        left = {f.rsplit("/", 2)[-2] for f in made.inputFiles()}
        assert left <= {"read", "ids", "edges"}, left
    assert set(common.WHILE_WRITING.values()).isdisjoint({spark.conf.get(k, None) for k in common.WHILE_WRITING})


def test_sieve_keeps_all_wanted_rows_without_a_shuffle_of_rows(spark):
    from frameloom.llm import common

    rows = spark.range(200_000).selectExpr("if(id = 7, null, cast(id as string)) as doc_id", "repeat('x', 20) as text")
    out = common.sieved(rows, "doc_id", rows.where("doc_id % 100 = 3").select("doc_id"))
    assert out.columns == rows.columns and out.where("doc_id is null").count() == 0
    assert out.where("doc_id % 100 = 3").count() == 2000 and out.count() < 2100
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(doc_id" not in plan and "SortMergeJoin" not in plan


def test_near_duplicate_stage_shuffles_no_texts(spark, tiny):
    """which rows stay is told by bits that are broadcast, whatever Spark would broadcast by itself."""
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"{'a b c d e f' if i < 3 else f'other words of row {i}'}", "en", "s", 9) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicate_stage(spark, docs, tiny)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [0, *range(3, 200)] and kept.columns == docs.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
