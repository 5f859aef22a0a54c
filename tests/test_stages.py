"""Stages are read again only if they were finished with the same inputs and parameters."""

import pytest
from pyspark.sql import functions as F

from firegrid import session
from firegrid.operators import report as S
from firegrid.plans import derived
from firegrid.plans.queries import PIXEL_RES, pixels, stripes
from firegrid.plans.runs import Config, Layer, processed_fires
from firegrid.sources import sinks
from tests.conftest import SF_SMALL
from tests.test_outline import parse, shoelace


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def forbidden():
    raise AssertionError("must not be computed")


def test_reuse_and_its_limits(spark, folder):
    src = f"{folder}/src"
    spark.range(5).write.parquet(src)
    path, read = f"{folder}/stage", lambda: spark.read.parquet(src)
    build = lambda: read().select((F.col("id") * 2).alias("v"))
    sinks.stage(spark, path, build, True, (read(),), {"day": 1})
    assert sinks.stage_rows(spark, path) == 5
    again = sinks.stage(spark, path, forbidden, False, (read(),), {"day": 1})
    assert sorted(r.v for r in again.collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(AssertionError):  # another parameter
        sinks.stage(spark, path, forbidden, False, (read(),), {"day": 2})
    assert sinks.stage(spark, path, forbidden, False, (read(),), {"day": 1}).count() == 5
    spark.range(7).write.mode("overwrite").parquet(src)
    assert sinks.stage(spark, path, build, False, (read(),), {"day": 1}).count() == 7  # other input files
    assert sinks.stage_rows(spark, path) == 7


def test_interrupted_write_is_not_reused(spark, folder):
    path = f"{folder}/stage"
    sinks.stage(spark, path, lambda: spark.range(3))

    def dies():
        stop = F.udf(lambda i: 1 / 0 if i == 2 else i, "long")
        return spark.range(4).select(stop("id").alias("id"))

    with pytest.raises(Exception):
        sinks.stage(spark, path, dies)
    assert sinks.read_manifest(spark, path) is None
    # Rows without a manifest, as an executor that was lost late may leave them.
    spark.range(2).write.mode("overwrite").parquet(path)
    assert sinks.stage(spark, path, lambda: spark.range(4), False).count() == 4
    with pytest.raises(ZeroDivisionError):
        sinks.stage(spark, path, lambda: 1 / 0)
    assert sinks.stage(spark, path, forbidden, False).count() == 4  # the build failed before anything was touched


def test_empty_stage(spark, folder):
    path = f"{folder}/none"
    assert sinks.stage(spark, path, lambda: spark.range(3).where("id > 5")).count() == 0
    assert sinks.stage(spark, path, lambda: spark.createDataFrame([], "a int")).count() == 0
    assert sinks.stage_rows(spark, path) == 0
    assert session.cut_counted(spark.createDataFrame([], "a int"))[1] == 0


def test_a_run_with_outlines(spark, folder):
    """The outline beside every sub-polygon has its area; the log's counts are those of the stored rows."""
    px = session.cut(pixels(spark, SF_SMALL))
    layers = [Layer("thematic", px.select("iy", "ix", "lct"), ("lct",)), Layer("continuous", px, ("tree", "herb", "bare"), (0, 100)), Layer("polygons", stripes(spark, SF_SMALL))]
    log = S.RunLog(spark)
    cfg = Config(layers, PIXEL_RES, path=f"{folder}/run", outlines=True)
    out = processed_fires(derived.detections(spark, SF_SMALL), cfg, log)
    div = spark.read.parquet(f"{folder}/run/work_div")
    events = {r.event: r for r in log.events().collect()}
    assert events["import"].n_after == spark.read.parquet(f"{folder}/run/work_pnt").count()
    assert events["subdiv"].n_after == div.count() > 0
    for r in div.where("area_sqkm > 1").limit(20).collect():
        polygons = parse(r.geom)
        square = sum(shoelace(ring) for poly in polygons for ring in poly)
        # A square degree at that latitude, to the order of the flattening.
        import math

        assert square * 111.195**2 * math.cos(math.radians(r.cen_lat)) == pytest.approx(r.area_sqkm, rel=0.02)
        assert 0 < r.compactness <= 1
    members = spark.read.parquet(f"{folder}/run/work_pnt_linked")
    sinks.write_polygons(out, members, f"{folder}/poly", outlines=div)
    rows = spark.read.parquet(f"{folder}/poly/polygons")
    assert rows.count() == out.count() and rows.where("geom IS NULL OR compactness IS NULL").isEmpty()
