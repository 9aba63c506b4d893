import glob
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import blocking as B
from tessera.operators import evaluation as E
from tessera.operators import features as FE
from tessera.operators import sampling as SA
from tessera.operators import tfidf as TF
from tessera.plans import model as M
from tessera.plans import queries as Q
from tessera.sources import tsv

SMALL = "/root/testdata/sf0.001"


def records(spark, rows):
    return spark.createDataFrame([(i, n, a, c) for i, n, a, c in rows], "entity_id string, business_name string, business_address string, country string")


@pytest.fixture(scope="module")
def two(spark):
    s1 = records(spark, [("S1-1", "acme steel works", "12 main street", "US"), ("S1-2", "blue bolt", "", "US"), ("S1-3", "", "", "US")])
    t = records(spark, [("S2-1", "acme steel works", "12 main street", "US"), ("S2-2", "acme steel corporation", "13 main street", "IN"), ("S3-1", "blue bolt", None, None), ("S3-2", "", "", "US")])
    return s1, t


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_exact(two):
    assert rows(B.block_exact(*two, "business_name"), "s1_id", "target_id") == [("S1-1", "S2-1"), ("S1-2", "S3-1")]


def test_token_overlap(two):
    assert rows(B.block_token_overlap(*two, "business_name", 2), "s1_id", "target_id") == [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-1")]
    assert rows(B.block_token_overlap(*two, "business_name", 2, most=1), "s1_id", "target_id") == [("S1-2", "S3-1")]


def test_phonetic(two):
    assert rows(B.block_phonetic(*two, "business_name"), "s1_id", "target_id") == [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-1")]


def test_tfidf_without_vocabulary(two):
    assert TF.block_tfidf(*two, "business_name", max_df=0.01).count() == 0


def test_features(spark, two):
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-9", "S2-1")], "s1_id string, target_id string")
    got = {(r["s1_id"], r["target_id"]): r for r in FE.feature_matrix(pairs, *two).collect()}
    assert len(FE.COLUMNS) == 28
    assert set(FE.COLUMNS) < set(got["S1-1", "S2-1"].asDict())
    assert got["S1-1", "S2-1"]["name_exact"] == got["S1-1", "S2-1"]["name_jw"] == 1
    assert got["S1-2", "S3-1"]["country_missing"] == 1
    assert got["S1-9", "S2-1"]["country_missing"] == 1
    assert got["S1-9", "S2-1"]["name_exact"] == 0


def pairs_of(spark, d):
    return spark.createDataFrame([(k, v) for k, vs in d.items() for v in vs] or [], "s1_id string, target_id string")


def test_f05(spark):
    cases = [([], [], 1.0), (["S2-1"], [], 0.0), ([], ["S2-1"], 0.0), (["a", "b"], ["b", "a"], 1.0), (["S2-1", "S2-2", "S3-1"], ["S2-1", "S3-1"], 0.7142857)]
    df = spark.createDataFrame([(k, p, a) for k, (p, a, _) in enumerate(cases)], "k int, p array<string>, a array<string>")
    got = [r["f"] for r in df.select("k", E.f05_arrays(F.col("p"), F.col("a")).alias("f")).orderBy("k").collect()]
    assert got == pytest.approx([c[2] for c in cases], abs=1e-6)


def test_macro_f05(spark):
    truth, entities = pairs_of(spark, {"A": ["x"], "C": ["y", "z"]}), spark.createDataFrame([("A",), ("B",), ("C",)], "s1_id string")
    assert E.macro_f05(truth, truth, entities).first()[0] == 1
    assert E.macro_f05(pairs_of(spark, {"A": ["x"], "Z": ["q"]}), truth, entities).first()[0] == pytest.approx(2 / 3)
    assert E.macro_f05(truth, truth, entities.limit(0)).first()[0] == 0


def test_tsv(spark, tmp_path):
    at = str(tmp_path / "a.tsv")
    Path(at).write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tNA\t\tUS\nS2-2\t"He said ""hi"""\tx\tnull\n')
    assert rows(tsv.load_source(spark, at), *tsv.RECORD) == [("S2-1", "NA", "", "US"), ("S2-2", 'He said "hi"', "x", "null")]
    assert tsv.load_source(spark, at, ["country"], 1).count() == 1
    bad = str(tmp_path / "b.tsv")
    Path(bad).write_text("entity_id\tcountry\nx\ty\n")
    with pytest.raises(ValueError, match="business_name"):
        tsv.load_source(spark, bad)


def test_grouped_twice(spark, two, tmp_path):
    s1, t = two
    pairs = pairs_of(spark, {"S1-1": ["S2-2", " S2-1", "S9-9", "S2-2"]})
    once = tsv.regrouped(pairs, s1, t)
    want = [("S1-1", "S2-1,S2-2"), ("S1-2", ""), ("S1-3", "")]
    assert rows(once, "source1_entity_id", "candidate_entity_ids") == want
    tsv.write_tsv(once, str(tmp_path / "c"))
    again = tsv.regrouped(tsv.read_pairs(spark, str(tmp_path / "c")), s1, t)
    assert rows(again, "source1_entity_id", "candidate_entity_ids") == want


def test_submission(tmp_path):
    (tmp_path / "x.tsv").write_text("a")
    assert tsv.submission(str(tmp_path), ["x.tsv", "y.tsv"], str(tmp_path / "o.zip")) == ["y.tsv"]


def test_sample_does_not_follow_partitions(spark):
    df = spark.range(1000)
    assert rows(SA.sample(df.repartition(7), "id", 50), "id") == rows(SA.sample(df, "id", 50), "id")


def test_model_round_trip(spark, tmp_path):
    features, model = Q._trained(spark, SMALL)
    M.MatchModel(model.model, 0.55).save(str(tmp_path / "m"))
    back = M.MatchModel.load(str(tmp_path / "m"))
    assert back.threshold == 0.55
    assert M.MatchModel.load(str(tmp_path / "m"), 0.9).threshold == 0.9
    a = rows(model.probabilities(features), "s1_id", "target_id", "probability")
    assert rows(back.probabilities(features), "s1_id", "target_id", "probability") == a


def test_stream(spark, two, tmp_path):
    from tessera.streaming.matching import match_stream

    s1, t = two
    t.na.fill("").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).parquet(str(tmp_path / "in"))
    seen = []
    match_stream(stream, s1, lambda a, b: B.block_exact(a, b, "business_name"), lambda p, n: seen.extend(rows(p, "s1_id", "target_id")), str(tmp_path / "ck")).awaitTermination()
    assert sorted(seen) == [("S1-1", "S2-1"), ("S1-2", "S3-1")]


@pytest.mark.parametrize("name", ["N4", "J1", "J3", "J5", "A5", "X3", "X4", "K2", "M6"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"create view {Path(f).stem} as from '{f}'")
    found = entry.queries()[name](spark, SMALL)
    columns = sorted(found.columns)
    want = con.sql(entry.oracle_sql()[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert sorted([tuple(r[c] for c in columns) for r in found.collect()], key=str) == sorted([tuple(r[k] for k in at) for r in want.fetchall()], key=str)


@pytest.mark.parametrize("name", ["M4", "M5", "M7", "M8", "M9", "A12", "R4", "I10", "K5"])
def test_queries_train_with_the_defaults(spark, monkeypatch, name):
    class Seen(Exception):
        pass

    def seen(features, settings):
        raise Seen(settings)

    monkeypatch.setattr("tessera.plans.model.fit", seen)
    with pytest.raises(Seen) as found:
        entry.queries()[name](spark, SMALL)
    assert found.value.args[0] == M.TreeSettings()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['corpus_pipeline'] = sys.modules['tessera.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'J3' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def brute_tfidf(mine, theirs, k, threshold, max_df, scoped=False):
    """All pairs, one by one: (s1_id, target_id, score)."""
    import math
    from collections import Counter

    def grams(text):
        return Counter(p[i : i + n] for w in text.split() for p in [f" {w} "] for n in (2, 3, 4) for i in range(len(p) - n + 1))

    df = Counter(g for _, t in mine for g in grams(t))
    idf = {g: math.log((1 + len(mine)) / (1 + n)) + 1 for g, n in df.items() if 2 <= n <= max_df * len(mine)}

    def vector(text):
        v = {g: n * idf[g] for g, n in grams(text).items() if g in idf}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / size for g, x in v.items()}

    out = []
    others = [(i, s, vector(t)) for i, t, s in theirs]
    for a, t in mine:
        v = vector(t)
        found = [(-s, b, c) for b, c, w in others if (s := round(sum(x * w[g] for g, x in v.items() if g in w), 6)) >= threshold]
        for c in ({f[2] for f in found} if scoped else {0}):
            out += [(a, b, -s) for s, b, _ in sorted(f for f in found if not scoped or f[2] == c)[:k]]
    return sorted(out)


@pytest.mark.parametrize("scope", ["global", "source"])
def test_tfidf_of_copies_in_small_blocks(spark, monkeypatch, scope):
    """Many copies, words in another order included, are one class; the blocks of both sides are more than one."""
    monkeypatch.setattr(TF, "LEFT", 3)
    monkeypatch.setattr(TF, "RIGHT", 4)
    monkeypatch.setattr(TF, "LEAST", 2)
    names = ["acme steel works", "steel works acme", "blue bolt", "blue bolts", "red bolt nine", "nine acme", "works works", "x", ""]
    mine = [(f"S1-{k:02}", names[k % 9]) for k in range(40)]
    theirs = [(f"S2-{(k * 37) % 100:02}", names[(k * 5) % 9], 2 + k % 2) for k in range(60)]
    s1 = spark.createDataFrame(mine, "entity_id string, business_name string")
    t = spark.createDataFrame(theirs, "entity_id string, business_name string, source int")
    assert TF.classes(s1, "business_name", [])[1].count() == 7
    got = TF.block_tfidf(s1, t, "business_name", 4, 0.3, 0.6, scope=scope)
    assert rows(got, "s1_id", "target_id", "score") == brute_tfidf(mine, theirs, 4, 0.3, 0.6, scope == "source")


def test_tfidf_makes_no_row_for_each_pair_of_copies(spark):
    """600 x 600 copies: the plan's joins make rows in proportion to the records."""
    s1 = spark.range(600).selectExpr("concat('a', id) AS entity_id", "'acme steel works' AS business_name")
    t = spark.range(600).selectExpr("concat('b', id) AS entity_id", "'acme steel works' AS business_name")
    got = TF.block_tfidf(s1, t, "business_name", 5, 0.5, 1.0)
    assert got.count() == 3000
    most, todo = 0, [got._jdf.queryExecution().executedPlan()]
    got._jdf.collectToPython()
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            p = p.plan()
        if p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(k) for k in range(p.children().size())]
    assert 0 < most <= 20_000


def most_rows(df):
    """The most rows that an operator of the plan makes."""
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    df._jdf.collectToPython()
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            p = p.plan()
        if p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(k) for k in range(p.children().size())]
    return most


@pytest.mark.parametrize("held", [0, 64 << 20])
def test_common_words_are_multiplied_once(monkeypatch, held):
    """400 x 900 names of three common words and one of their own, repeats included; before, all postings of a name were added up for each name."""
    import numpy as np
    import pyarrow as pa

    names = lambda k, s: " ".join(sorted(["steel"] * (1 + k % 2) + ["acme", f"works{k % 3}", f"{s}{k}"]))
    mine, theirs = [names(k, "x") for k in range(400)], [names(k, "y") for k in range(900)]
    count = Counter(g for n in mine + theirs for w in n.split(" ") for g in set(TF.grams_of(w)))
    known = {g: k for k, g in enumerate(sorted(count))}
    idf = np.array([1 + np.log(2_000 / count[g]) for g in known])
    added, real = [], np.bincount
    monkeypatch.setattr(TF, "HELD", held)
    table = pa.table({"mine": [True] * 400 + [False] * 900, "words": mine + theirs, "first": [None] * 400 + [f"{k:04}" for k in range(900)]})
    vectors = lambda others, words: (TF._matrix(others, known, idf), *TF._by_word(words, known, idf), len(idf))
    work = TF._nearest(vectors, 5, 0.3, [])
    monkeypatch.setattr(np, "bincount", lambda x, *a, **b: added.append(len(x)) or real(x, *a, **b))
    got = [tuple(r.values()) for r in work(table).to_pylist()]
    monkeypatch.undo()
    dense = np.zeros((1_300, len(idf)))
    row, gram, weight = TF._matrix(mine + theirs, known, idf)
    dense[row, gram] = weight
    score = np.floor(dense[:400] @ dense[400:].T * 1e6 + 0.5) / 1e6
    best = [(mine[i], theirs[k], f"{k:04}", score[i, k]) for i in range(400) for k in sorted(range(900), key=lambda k: (-score[i, k], k))[:5] if score[i, k] >= 0.3]
    assert got == best
    assert not held or sum(added) < 1_000_000


def shuffled_rows(df):
    """The most rows that an exchange of the plan writes."""
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    df._jdf.collectToPython()
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            p = p.plan()
        if p.metrics().contains("shuffleRecordsWritten"):
            most = max(most, p.metrics().apply("shuffleRecordsWritten").value())
        todo += [p.children().apply(k) for k in range(p.children().size())]
    return most


def test_exact_shuffles_records_not_pairs(spark):
    """200 x 300 copies, repeated rows, and ids of several names that meet more than once; before, all 60,000 pairs were shuffled."""
    names = lambda df, *more: df.unionByName(spark.createDataFrame(list(more), "entity_id string, business_name string"))
    s1 = names(spark.range(200).selectExpr("concat('a', id) AS entity_id", "'acme steel' AS business_name"), ("a0", "acme steel"), ("a1", "blue bolt"), ("a2", "only"), (None, "blue bolt"))
    t = names(spark.range(300).selectExpr("concat('b', id) AS entity_id", "'acme steel' AS business_name"), ("b0", "acme steel"), ("b1", "blue bolt"), ("b2", "only"), ("b3", "rest"), ("b4", None), ("b5", " "))
    got = B.block_exact(s1, t, "business_name")
    pairs = [(r["s1_id"], r["target_id"]) for r in got.collect()]
    assert len(pairs) == 60_001
    assert set(pairs) == {(f"a{i}", f"b{k}") for i in range(200) for k in range(300)} | {(None, "b1")}
    assert 0 < shuffled_rows(got) <= 2_000


def test_token_overlap_makes_no_row_for_each_pair_of_names(spark):
    """400 x 400 different names with three words in common; before, a join made 160,000 rows of them."""
    s1 = spark.range(400).selectExpr("concat('a', id) AS entity_id", "concat('acme steel works x', id) AS business_name")
    t = spark.range(400).selectExpr("concat('b', id) AS entity_id", "concat('works steel acme y', id) AS business_name")
    got = B.block_token_overlap(s1, t, "business_name", 2, 5)
    assert rows(got, "s1_id", "target_id") == sorted((f"a{k}", b) for k in range(400) for b in ("b0", "b1", "b10", "b100", "b101"))
    assert 0 < most_rows(got) <= 20_000


@pytest.mark.parametrize("most", [5000, 20])
def test_token_overlap_in_small_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(TF, "LEFT", 3)
    monkeypatch.setattr(TF, "RIGHT", 4)
    monkeypatch.setattr(TF, "LEAST", 2)
    names = ["acme steel works", "steel works acme acme", "blue bolt", "blue bolts of acme", "red bolt nine", "nine acme", "red red", "x", "", None]
    mine = [(f"S1-{k:02}", names[k % 10]) for k in range(40)]
    theirs = [(f"S2-{(k * 37) % 100:02}", names[(k * 3) % 10]) for k in range(60)]
    sides = [spark.createDataFrame(x, "entity_id string, business_name string") for x in (mine, theirs)]
    own = lambda text: {w for w in (text or "").split() if len(w) > 2}
    rare = {w for _, t in theirs for w in own(t) if sum(w in own(x) for _, x in theirs) <= most}
    want = []
    for a, x in mine:
        near = sorted((-n, b) for b, y in theirs if (n := len(own(x) & own(y) & rare)) >= 1)[:4]
        want += [(a, b) for _, b in near]
    assert rows(B.block_token_overlap(*sides, "business_name", 1, 4, most), "s1_id", "target_id") == sorted(want)


def test_strategies_are_worked_once_for_equal_records(spark, monkeypatch):
    """30 copies of two records of source 1 go to the strategies as two, with the weights of 30, and all of them come back."""
    s1 = records(spark, [(f"a{k:02}", n, x, "") for k in range(30) for n, x in [("acme steel works" if k % 2 else "blue bolt", "12 main street" if k % 2 else None)]] + [("c", "other thing", "", "")])
    t = records(spark, [("b1", "acme steel works", "12 main street", ""), ("b2", "blue bolt", "", ""), ("b3", "acme steel thing", "12 side street", "")])
    given, whole = [], B.block_exact
    monkeypatch.setattr(B, "block_exact", lambda few, *a: given.append(rows(few, "entity_id", "n")) or whole(few, *a))
    got = rows(B.block_multi_strategy(s1, t, max_df=1.0), "s1_id", "target_id", "strategies")
    assert given == [[("a00", 15), ("a01", 15), ("c", 1)]]
    assert got == sorted(x for k in range(30) for x in ([(f"a{k:02}", "b1", ["exact_name", "tfidf_address", "tfidf_name", "token_overlap"]), (f"a{k:02}", "b3", ["tfidf_address", "tfidf_name", "token_overlap"])] if k % 2 else [(f"a{k:02}", "b2", ["exact_name", "tfidf_name", "token_overlap"])]))


def test_sample_sorts_few_rows(spark):
    """All rows are the frame itself; a part is that of a whole sort, of which only rows about the cut are sorted."""
    df = spark.range(20_000).selectExpr("concat('k', id) AS id")
    assert SA.sample(df, "id", 20_000) is df
    got = SA.sample(df, "id", 7_000)
    assert rows(got, "id") == rows(df.orderBy(SA.hashed(F.concat("id", F.lit("/42"))), "id").limit(7_000), "id")
    plan = got._jdf.queryExecution().toString()
    assert int(plan.split("TakeOrderedAndProject(limit=")[1].split(",")[0]) < 100


def made_up(n):
    import numpy as np

    g = np.random.default_rng(7)
    x = [g.integers(0, 50, n) / 50 for _ in range(6)]
    return x, ((x[0] > 0.5) ^ (x[1] > 0.3)).astype("int8"), np.arange(n)


def test_trees_do_not_depend_on_how_rows_are_dealt():
    import threading

    import numpy as np

    from tessera.plans import trees as T

    x, y, key = made_up(3000)
    settings = M.TreeSettings(rounds=12)
    alone = T.grown(x, y, key, settings, lambda a: [a], lambda a: a)
    assert ((alone.probabilities(x) > 0.5) == y).mean() > 0.98
    meet, given, found = threading.Barrier(3), [None] * 3, [None] * 3

    def task(k):
        def gather(a):
            given[k] = T.unpacked(T.packed(a))
            meet.wait()
            out = list(given)
            meet.wait()
            return out

        part = np.flatnonzero(key % 5 == k) if k < 2 else np.flatnonzero(key % 5 > 1)
        found[k] = T.grown([c[part] for c in x], y[part], key[part], settings, gather, lambda a: sum(gather(a)))

    tasks = [threading.Thread(target=task, args=(k,)) for k in range(3)]
    [t.start() for t in tasks]
    [t.join(60) for t in tasks]
    assert [f.text() for f in found] == [alone.text()] * 3
    assert T.Trees.of(alone.text()).probabilities(x).tolist() == alone.probabilities(x).tolist()


def test_all_rounds_are_a_few_jobs(spark, monkeypatch):
    """100 rounds of depth 6 were some 700 jobs."""
    x, y, key = made_up(2000)
    at = [FE.COLUMNS.index(c) for c in FE.COLUMNS[:6]]
    monkeypatch.setattr("tessera.plans.trees.TASK_ROWS", 500)
    df = spark.createDataFrame([(f"a{k}", f"b{k}", int(y[k]), *[float(x[c][k]) if c in at else 0.0 for c in range(28)]) for k in range(2000)], ["s1_id", "target_id", "label", *FE.COLUMNS])
    spark.sparkContext.setJobGroup("trees", "")
    model = M.MatchModel(M.fit(df, M.TreeSettings()))
    spark.sparkContext.setJobGroup("others", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("trees")) <= 6
    assert len(model.model.trees) == 100
    right = model.probabilities(df).where("(probability >= 0.5) = (label = 1)").count()
    assert right > 1980
    shares = {r["feature"]: r["importance"] for r in model.importances().collect()}
    assert sum(shares.values()) == pytest.approx(1)
    assert set(sorted(shares, key=shares.get)[-2:]) == set(FE.COLUMNS[:2])
