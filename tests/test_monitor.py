import math

from hourcast.operators import monitor as MON


def _scored(spark, rows):
    return spark.createDataFrame(rows, "segment int, row_key string, raw_label double, prediction double")


def test_alert_rules(spark):
    rows = [
        (1, "zero-measured", 0.0, math.log(10.0)),      # outage -> alert
        (1, "zero-both", 0.0, -5.0),                     # floor(exp(-5)) = 0 -> no alert
        (1, "big-drop", 100.0, math.log(200.0)),         # +100 % -> alert
        (1, "small-drop", 100.0, math.log(120.0)),       # +20 % -> none
        (1, "over", 100.0, math.log(50.0)),              # -50 % -> none
    ]
    got = {r.row_key: r for r in MON.score_errors(_scored(spark, rows)).collect()}
    assert got["zero-measured"].is_alert and got["zero-measured"].error_pct is None
    assert not got["zero-both"].is_alert
    assert got["big-drop"].is_alert
    assert got["big-drop"].predicted in (199, 200) and got["big-drop"].error_pct in (99.0, 100.0)
    assert got["small-drop"].error_pct in (19.0, 20.0)
    assert not got["small-drop"].is_alert and not got["over"].is_alert
    al = {r.row_key: r.message for r in MON.alerts(_scored(spark, rows)).collect()}
    assert set(al) == {"zero-measured", "big-drop"}
    assert al["zero-measured"].endswith("error outage")


def test_measured_is_floor_of_raw(spark):
    r = MON.score_errors(_scored(spark, [(1, "k", 4021.0, math.log(4021.0))])).first()
    assert r.measured == 4021


def test_message_names_the_features(spark):
    from pyspark.sql import functions as F

    row = _scored(spark, [(1, "k", 10.0, math.log(40.0))]).withColumns({"errors": F.lit(3.0), "no_credit": F.lit(None).cast("double")})
    r = MON.alerts(row, features=MON.features_text(["errors", "no_credit"])).first()
    assert r.message.endswith("(errors=3.00, no_credit=null)")


def test_outage_alerts_without_any_alert(spark, tmp_path):
    """Even traffic raises no alert: the alerts table stays without a file and is read as empty."""
    from hourcast.plans.catalog import REGISTRY

    hours = spark.range(5 * 30 * 6).selectExpr(
        "id % 5 as user_id", "cast(floor(id / 5) % 30 as int) as d", "cast(floor(id / 150) as int) as h")
    events = hours.selectExpr("user_id", "d", "h", "explode(sequence(1, 30 + h + d % 3)) as i").selectExpr(
        "monotonically_increasing_id() as event_id", "make_timestamp_ntz(2024, 1, d + 1, h, i, 0) as ts", "user_id",
        "case when i <= 20 + h then 'purchase' when i % 2 = 0 then 'view' else 'error' end as event_type",
        "cast(i as double) as value", "cast(null as string) as props")
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert REGISTRY["score_alerts"](spark, str(tmp_path)).count() == 0
    out = REGISTRY["outage_alerts"](spark, str(tmp_path))
    assert out.collect() == []
    assert out.columns == ["segment", "row_key", "measured", "predicted", "message"]
