import json
import warnings

import pytest
from pyspark.sql import functions as F

from certiscope import vocab
from certiscope.operators.features import FeatureEncoder, fit_features
from certiscope.plans import prepare
from certiscope.session import work_dir
from certiscope.sources import geojson, register
from certiscope.streaming import incremental


def write_year(folder, year, rows, header):
    folder.mkdir(exist_ok=True)
    path = folder / f"certificates-{year}.csv"
    path.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n", encoding="latin-1")
    return str(path)


HEADER = ["uprn", "lodgement_date", "current_energy_rating", "potential_energy_rating", "property_type",
          "current_energy_efficiency", "potential_energy_efficiency", "tenure", "walls_energy_eff", "total_floor_area"]


@pytest.fixture()
def files(tmp_path):
    f = tmp_path / "raw"
    return [
        write_year(f, 2024, [["1.0", "2024-05-01", " d", "B", "House ", "50", "80", "Caf\xe9", "N/A", "90"],
                             ["2", "2024-01-01", "E", "B", "Flat", "junk", "80", "x", "Good", "50"],
                             ["3", "2024-02-01", "E", "C", "Flat", "40", "70", "x", "Good", "-1"]], HEADER),
        write_year(f, 2025, [["1", "2025-02-01", "D", "B", "House", "60", "81", "y", "Poor", "88"],
                             ["4", "not a date", "D", "B", "House", "60", "81", "y", "Poor", "88"],
                             ["nan", "2025-02-01", "D", "B", "House", "60", "81", "y", "Poor", "88"]], HEADER),
        write_year(f, 2023, [["9", "2023-01-01", "D"]], HEADER[:3]),
        str(f / "certificates-2022.csv"),
    ]


def test_yearly_files_to_prepared_table(spark, files, tmp_path):
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        out = prepare.prepare_files(spark, files, str(tmp_path / "out"))
    told = [str(w.message) for w in caught]
    assert any("2022" in t and "not found" in t for t in told) and any("2023" in t and "missing columns" in t for t in told)
    rows = out.collect()
    assert [(r.UPRN, r.LODGEMENT_DATE, r.split, r.FILE_YEAR, r.RETROFIT_POTENTIAL) for r in rows] == [("1", "2025-02-01", "test", 2025, 1)]


def test_text_values_survive(spark, files):
    row = register.read_csv(spark, files[0]).where("uprn = '1.0'").first()
    assert row.tenure == "Caf\xe9" and row.walls_energy_eff is None and row.current_energy_rating == " d"


def test_years_with_different_columns(spark, tmp_path):
    f = tmp_path / "raw"
    a = write_year(f, 2024, [["1", "2024-05-01", "D", "B", "House", "50", "80", "own"]], HEADER[:8])
    b = write_year(f, 2025, [["x", "2", "2025-05-01", "D", "B", "House", "50", "80"]], ["extra", *HEADER[:7]])
    rows = {r.UPRN: r for r in register.read_years(spark, [a, b]).collect()}
    assert rows["1"].TENURE == "own" and rows["2"].TENURE is None and rows["2"].FILE_YEAR == 2025


def test_read_sample(spark, files):
    assert register.read_sample(spark, files[0], 2, ["uprn"]).count() == 2
    assert register.read_sample(spark, files[0], 99, ["uprn"]).count() == 3


def test_date_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).select(F.concat(F.lit("20"), (F.col("id") + 20).cast("string"), F.lit("-03-01")).alias("LODGEMENT_DATE"), "id").write.parquet(path)
    from certiscope.operators.cleaning import in_year

    df = in_year(spark.read.parquet(path), 2023).select("LODGEMENT_DATE")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(LODGEMENT_DATE,2023-01-01)" in plan and "ReadSchema: struct<LODGEMENT_DATE:string>" in plan
    assert df.count() == 1


def test_geojson_kinds(spark, tmp_path):
    ring = [[0, 0], [2, 0], [2, 1], [0, 0]]
    hole = [[1, 1], [1, 2], [2, 2], [1, 1]]
    polygon = {"type": "Polygon", "coordinates": [ring, hole]}
    multi = {"type": "MultiPolygon", "coordinates": [[ring], [ring, hole]]}
    shapes = {"p": polygon, "m": multi, "c": {"type": "GeometryCollection", "geometries": [polygon, multi]},
              "point": {"type": "Point", "coordinates": [1, 2]}}
    path = tmp_path / "b.geojson"
    path.write_text(json.dumps({"features": [{"properties": {"name": n}, "geometry": g} for n, g in shapes.items()]}, indent=1))
    rings = geojson.rings(geojson.read_geojson(spark, str(path)))
    assert {r.name: r["count"] for r in rings.groupBy("name").count().collect()} == {"p": 1, "m": 2, "c": 3}
    assert {r.name: (r.lon, r.lat) for r in geojson.ring_anchors(rings).collect()}["c"] == (1.0, 0.25)
    box = geojson.padded_box(rings).first()
    assert (box.x_min, box.x_max) == pytest.approx((-.08, 2.08))


def test_encoder_saved_and_loaded(spark, three, tmp_path):
    from certiscope.operators.cleaning import add_wall_type

    rows = add_wall_type(three)
    enc = fit_features(rows)
    enc.save(spark, str(tmp_path / "enc"))
    back = FeatureEncoder.load(spark, str(tmp_path / "enc"))
    assert back == enc and back.names == enc.names
    unseen = rows.withColumn("PROPERTY_TYPE", F.lit("Castle")).withColumn("CURRENT_ENERGY_RATING", F.lit("?"))
    wide = enc.wide(unseen, []).first().asDict()
    assert wide["CURRENT_ENERGY_RATING"] == -1.0 and wide["PROPERTY_TYPE_House"] == 0.0


class Told:
    """A session that only knows its settings."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"test-{master}"})


def test_shared_folder_comes_from_the_session():
    assert work_dir(Told("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_dir(Told("local[2]", "/shared"), "x") != work_dir(Told("local[2]", "/shared"), "x")
    with pytest.raises(ValueError):
        work_dir(Told("yarn"), "x")


def test_incremental_load_keeps_the_newest(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in vocab.REQUIRED_COLUMNS)

    def arrive(name, rows):
        full = [(u, d, "D", "B", "House", "50", "80") for u, d in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    src, out, progress = str(tmp_path / "in" / "*"), str(tmp_path / "out"), str(tmp_path / "progress")
    arrive("a", [("1", "2024-01-01"), ("2", "2024-01-01")])
    from pyspark.sql.types import StructType

    typed = StructType.fromDDL(schema)
    incremental.start_load(incremental.watch_files(spark, src, typed), out, progress).awaitTermination()
    arrive("b", [("1", "2023-01-01"), ("2", "2025-01-01"), ("3", "2025-01-01")])
    incremental.start_load(incremental.watch_files(spark, src, typed), out, progress).awaitTermination()
    now = {r.UPRN: r.LODGEMENT_DATE for r in incremental.current(spark, out).collect()}
    assert now == {"1": "2024-01-01", "2": "2025-01-01", "3": "2025-01-01"}
    incremental.compact(spark, out, str(tmp_path / "compact"))
    assert incremental.current(spark, str(tmp_path / "compact")).count() == 3
