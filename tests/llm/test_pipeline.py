import corpus_pipeline
from corpus_pipeline import NEAR_THRESHOLD, NEAR_WORDS, STAGES, run
from test_jaccard_join import brute as near_components
from test_packing import best_fit_decreasing, check_gapless

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, texts(docs)
    kept = {}
    for name, stage in STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != STAGES[-1][0]:
            assert docs.columns == columns
            kept[name] = texts(docs)
            assert set(kept[name].items()) <= set(before.items())
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = before.keys() - kept["toxicity"].keys()
    assert all(toxic.get(k, 1) == 1 for k in gone)

    best = {}
    for k, t in kept["toxicity"].items():
        best[t.translate(LOW)] = max(k, best.get(t.translate(LOW), k))
    assert kept["exact_dedup"].keys() == set(best.values())

    near = near_components(sorted(kept["exact_dedup"].items()), NEAR_WORDS, NEAR_THRESHOLD)
    assert kept["near_dedup"].keys() == {k for k, (_, c) in near.items() if c == k}

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert kept["decontamination"].keys() == {
        k for k, t in kept["near_dedup"].items() if not any(i in t for i in items)}

    rows = docs.collect()
    assert {r.doc_id for r in rows} == kept["decontamination"].keys()
    assert len(check_gapless(rows, 4096)) == len(best_fit_decreasing([r.length for r in rows], 4096))


def test_rows_of_one_id_leave_by_their_own_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long), (2, long + " end"), (2, "a text of its own without any copy"),
            (3, long + " more"), (3, other), (4, other + " end"), (None, other + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in corpus_pipeline.remove_near_copies(spark, docs, SF).collect()}
    assert got == {rows[0], rows[2], rows[4], rows[6]}


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    rows = [(1, None, "a"), (2, "", "b"), (None, "one two three", "c"), (3, "x y z " * 30_000, "d"),
            (4, "same text here", "e"), (4, "same text here", "f"), (5, "Same Text Here", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").selectExpr(
        "score", "doc_id", "text", "'k' as kept", "1 as _id", "2 as predicted")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    got = sorted((r.doc_id or 0, r.score) for r in docs.collect())
    assert got == [(0, "c"), (2, "b"), (3, "d"), (5, "g")]
    assert docs.columns == ["score", "doc_id", "text", "kept", "_id", "predicted"]
    empty = docs.limit(0)
    assert all(stage(spark, empty, SF).count() == 0 for _, stage in STAGES)


def test_run_and_contract(spark):
    assert [name for name, _ in STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert run(spark, SF).count() > 100
