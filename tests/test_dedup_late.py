from certiscope.operators import dedup


def test_late_equals_max_by(spark, tmp_path):
    """Winners chosen on narrow rows and fetched by place equal the one-step choice, by broadcast or by shuffle."""
    rows = [(f"K{k % 7}" if k % 11 else None, f"2020-0{1 + k % 9}-1{k % 3}", k % 4, k, "x" * (k % 50), float(k))
            for k in range(300)]
    df = spark.createDataFrame(rows, "UPRN string, LODGEMENT_DATE string, T1 int, T2 int, WIDE string, AREA double")
    path = str(tmp_path / "t")
    df.repartition(5).write.parquet(path)
    stored = spark.read.parquet(path)
    want = sorted(map(tuple, dedup.latest_per_key(stored, ties=["T1", "T2"]).collect()), key=repr)
    assert sorted(map(tuple, dedup.latest_per_key_late(stored, ties=["T1", "T2"]).collect()), key=repr) == want
    old = dedup.BROADCAST_PLACES
    dedup.BROADCAST_PLACES = 0
    try:
        assert sorted(map(tuple, dedup.latest_per_key_late(stored, ties=["T1", "T2"]).collect()), key=repr) == want
    finally:
        dedup.BROADCAST_PLACES = old
    assert len(want) == 8 and dedup.latest_per_key_late(stored.drop("UPRN")).columns == [c for c in stored.columns if c != "UPRN"]


def test_wide_rows_and_paths_stay_out_of_the_shuffle(spark, tmp_path, monkeypatch):
    """The rows are filtered by bits where they are read, a thousand rows in one row of the place table."""
    monkeypatch.setattr(dedup, "BROADCAST_PLACES", 20)
    df = spark.range(5000).selectExpr("cast(id % 1700 as string) AS UPRN", "cast(date_add(date'2020-01-01', cast(id % 90 as int)) as string) "
                                      "AS LODGEMENT_DATE", "id AS T1", "repeat('w', 40) AS WIDE")
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    late = dedup.latest_per_key_late(stored, ties=["T1"])
    assert "hashpartitioning" not in late._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, dedup.latest_per_key(stored, ties=["T1"]).collect()))


def test_late_limits(spark, monkeypatch):
    """More rows of the place table than may be broadcast, one file with many chunks, and an empty table."""
    from certiscope.session import stored
    df = stored(spark.range(9000).selectExpr("cast(id % 4000 as string) AS UPRN", "'2020-01-01' AS LODGEMENT_DATE", "id AS T1").coalesce(1))
    want = sorted(map(tuple, dedup.latest_per_key(df, ties=["T1"]).collect()))
    for limit in (400_000, 3):
        monkeypatch.setattr(dedup, "BROADCAST_PLACES", limit)
        assert sorted(map(tuple, dedup.latest_per_key_late(df, ties=["T1"]).collect())) == want
    empty = stored(df.where("T1 < 0"))
    assert dedup.latest_per_key_late(empty, ties=["T1"]).collect() == []
