"""The daily view kept up by change sets equals the full recomputation."""
from pyspark.sql import functions as F

from berthline.operators import gold
from berthline.plans import pipeline as plans
from berthline.streaming.daily_view import DailyView


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_late_rows_recompute_their_dates_alone(spark, tmp_path):
    p = plans.silver_from_testdata(spark, "/root/testdata/sf0.001", processing_time=False)
    whole = {"export": (p.export_flow, "gate_in_timestamp"), "import": (p.import_flow, "gate_out_timestamp"),
             "crane": (p.crane, "crane_timestamp")}
    mid = F.to_timestamp(F.lit("2024-01-15"))
    late_day = F.to_timestamp(F.lit("2024-01-03"))

    def arrives(ts, part):
        """0: most rows before mid, 1: the rest from mid on, 2: late rows of two days and rows without a time."""
        t = F.col(ts)
        late = t.isNull() | ((t >= late_day) & (t < late_day + F.expr("INTERVAL 1 DAY")) & (F.minute(t) < 20))
        return [(t < mid) & ~late, (t >= mid) & ~late, late][part]

    def inputs():
        return {n: (spark.read.parquet(str(tmp_path / n)), ts) for n, (_, ts) in whole.items()}

    view, done, days = DailyView(spark, str(tmp_path / "view")), [], []
    for part in range(3):
        for name, (df, ts) in whole.items():
            df.where(F.coalesce(arrives(ts, part), F.lit(part == 2))).write.mode("append").parquet(str(tmp_path / name))
        done.append(view.refresh(inputs(), processing_time=False))
        days.append(view.days())
        now = inputs()
        want = gold.terminal_daily_summary(now["export"][0], now["import"][0], now["crane"][0], False)
        assert _rows(view.read()) == _rows(want) and want.count() > 0
    # the second part lies in other dates, the third touches one date: all others keep their files
    assert done[1].kept_dates >= 13
    changed = {d for d in days[2] if days[1].get(d) != days[2][d]}
    assert changed <= {"2024-01-03", "none"} and "2024-01-03" in changed and done[2].kept_dates == len(days[2]) - len(changed)
    # nothing new: nothing is computed
    assert view.refresh(inputs(), processing_time=False).new_files == 0 and view.days() == days[2]
