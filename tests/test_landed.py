"""CSV readers: malformed lines, missing values, date ranges."""

import datetime as dt

from tickwise.sources import landed


def test_series(spark, tmp_path):
    lines = ["date,value", "2024-01-01,1.5", "2024-01-02,", "2024-01-03,n/a", "not a date,3", "2024-01-05,NaN", ",4.0",
             "2024-01-06,2.5,extra", "2024-01-07,7", "2023-12-31,0", "2024-01-08,Infinity"]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    rows = {r.date: r.value for r in landed.read_series(spark, str(tmp_path), "VIX", start="2024-01-01", end="2024-01-07").collect()}
    day = lambda n: dt.date(2024, 1, n)
    assert rows == {day(1): 1.5, day(2): None, day(5): None, day(7): 7.0}
    found = landed.audit(landed.series_lines(spark, str(tmp_path))).first().asDict()
    assert found == {"n_lines": 10, "n_corrupt": 3, "n_undated": 1, "n_missing": 3, "first_date": dt.date(2023, 12, 31),
                     "last_date": day(8)}
    kept = landed.series_lines(spark, str(tmp_path)).where("_corrupt is not null").collect()
    assert {r._corrupt for r in kept} == {"2024-01-03,n/a", "not a date,3", "2024-01-06,2.5,extra"}


def test_bars_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text("symbol,date,open,high,low,close,volume\nA,2024-01-02,1,2,0.5,1.5,10\n"
                                    "A,2024-01-03,1,2,0.5,,10\nB,2024-01-02,1,2,0.5,NaN,10\n,2024-01-02,1,1,1,1,1\n"
                                    "A,2024-02-30,1,1,1,1,1\nC,2024-01-09,1,1,1,1,1\n")
    rows = landed.read_bars_csv(spark, str(tmp_path), symbols=["A", "B"], end="2024-01-05").collect()
    assert sorted((r.symbol, r.date.day, r.close) for r in rows if r.close) == [("A", 2, 1.5)]
    assert sorted((r.symbol, r.date.day) for r in rows) == [("A", 2), ("A", 3), ("B", 2)]
