"""The registered sink queries write a partition per day."""

from __future__ import annotations

import datetime

from bondmart import operator_queries as Q
from conftest import SF_SMALL


def test_sink_report_writes_days_and_some_of_them_again(spark, monkeypatch):
    calls, write = [], Q.write_report

    def spy(df, path, partition_by=("deal_dt",), fmt="parquet", days=None):
        calls.append((path, tuple(partition_by), days))
        write(df, path, partition_by, fmt, days)

    monkeypatch.setattr(Q, "write_report", spy)
    got = Q.OPERATOR_QUERIES["sink_report"](spark, SF_SMALL)
    assert [by for _, by, _ in calls] == [("deal_dt",)] * 2 and calls[0][2] is None
    gone, *days = calls[1][2]
    assert len(days) == Q.RERUN_DAYS and gone == days[0] - datetime.timedelta(days=1)
    assert got.where(got.deal_dt == gone).count() == 0 and got.where(got.deal_dt.isin(days)).count() > 0
