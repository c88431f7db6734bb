"""Dimension seeding is insert-only and idempotent; state ids continue."""

from sluice.plans import dimensions as dim


def test_states_seeded_once_with_consecutive_ids(spark):
    empty = spark.createDataFrame([], "state_id BIGINT, state STRING, created_at TIMESTAMP_NTZ")
    first = dim.seed_states(spark, empty, "2024-01-01 00:00:00", states=dim.STATES[:10])
    assert sorted(r.state_id for r in first.collect()) == list(range(1, 11))
    second = dim.seed_states(spark, first, "2024-02-01 00:00:00")
    rows = second.collect()
    assert len(rows) == 51 and len({r.state for r in rows}) == 51
    assert sorted(r.state_id for r in rows) == list(range(1, 52))
    again = dim.seed_states(spark, second, "2024-03-01 00:00:00")
    assert again.count() == 51


def test_codes_and_ori(spark):
    empty = spark.createDataFrame([], "offense_code INT, created_at TIMESTAMP_NTZ")
    codes = dim.seed_codes(spark, empty, dim.ARREST_OFFENSE_CODES, "offense_code", "INT", "2024-01-01 00:00:00")
    assert codes.count() == 47
    assert dim.seed_codes(spark, codes, dim.ARREST_OFFENSE_CODES, "offense_code", "INT",
                          "2024-02-01 00:00:00").count() == 47
    sup = spark.createDataFrame([], "offense_code STRING, created_at TIMESTAMP_NTZ")
    assert dim.seed_codes(spark, sup, dim.SUPPLEMENTAL_OFFENSE_CODES, "offense_code", "STRING",
                          "2024-01-01 00:00:00").count() == 4
    ori = spark.createDataFrame([("A1", None, None)], "ori STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")
    agencies = spark.createDataFrame([("A1",), ("B2",), (None,), ("B2",)], "ori STRING")
    out = {r.ori: (r.created_at is None, r.updated_at is not None)
           for r in dim.seed_ori(ori, agencies, "2024-02-01 00:00:00").collect()}
    assert out == {"A1": (True, True), "B2": (False, True)}


def test_grid_seeded_into_full_marks_table(spark):
    from sluice.plans import highwater as hw
    marks = spark.createDataFrame([("ARREST", "NATIONAL", "<NONE>", 11, "01-1999", "12-2020", 0, None, None, None, None)],
                                  hw.ARREST_MARKS_DDL)
    states = spark.createDataFrame([("WA",), ("OR",)], "state STRING")
    oris = spark.createDataFrame([("WA001",)], "ori STRING")
    g = hw.arrest_grid(spark, [11, 23], states, oris)
    seeded = hw.seed_grid(marks, g, hw.GRID_KEYS, "2024-02-01 00:00:00")
    rows = seeded.collect()
    assert len(rows) == 8                                    # (1 national + 2 states + 1 ori) x 2 codes
    kept = [r for r in rows if r.offense_code == 11 and r.report_granularity == "NATIONAL"][0]
    assert (kept.first_date, kept.last_date, kept.created_at) == ("01-1999", "12-2020", None)
    new = [r for r in rows if r.report_level == "WA001"]
    assert all(r.created_at is not None and r.last_date is None for r in new)
    planned = hw.plan_months(seeded, "01-1999", "03-2026")
    months = {(r.report_level, r.offense_code): r.from_month for r in planned.collect()}
    assert months[("<NONE>", 11)] == "01-2021" and months[("WA", 23)] == "01-1999"
