"""The rebuild from the landing reduces messages to their first arrival once."""

from paths import SF_SMALL

from dealstream.operators import decide as D
from dealstream.plans import queries_io as QI


def test_rebuild_dedups_once(spark, monkeypatch):
    calls, plain = [], D.dedup_first

    def counted(df, *args, **kwargs):
        calls.append(1)
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(D, "dedup_first", counted)
    QI.q_rebuild_equals_stream(spark, SF_SMALL)
    assert len(calls) == 1
