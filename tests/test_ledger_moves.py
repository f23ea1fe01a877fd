"""Which rows of a ledger batch are moved to remove copies."""

import json

from siltbed.plans.refine import clean_events


def test_ledger_moves_only_repeated_rows(spark, tmp_path, monkeypatch):
    """Before, every timely row of a batch went through the removal of copies."""
    from siltbed.streaming import ledger_stream as ls

    def batch(*events):
        rows = [
            (json.dumps({"id": i, "type": "edit", "title": f"T{i}", "wiki": "enwiki", "timestamp": t, "meta": {"id": f"m{i}", "domain": "d"}}), f"m{i}", t)
            for i, t in events
        ]
        return spark.createDataFrame(rows, "event_json STRING, event_key STRING, produced_at BIGINT")

    moved = []
    monkeypatch.setattr(ls, "clean_events", lambda rows: moved.append(sorted(r.event_id for r in rows.collect())) or clean_events(rows))
    root, t = str(tmp_path / "sinks"), 1_700_000_000
    assert ls.refine_batch(batch((1, t), (2, t), (3, t), (3, t)), 0, root)
    # 2 is known and on time, 3 is known and late, 5 is late twice, 6 late once.
    assert ls.refine_batch(batch((2, t), (3, t - 900), (4, t), (5, t - 900), (5, t - 900), (6, t - 900)), 1, root)
    assert moved == [[3, 3], [2]]
    ids = lambda sink: sorted(r.event_id for r in ls.read_sink(spark, root, sink).collect())
    assert ids(ls.CLEAN) == [1, 2, 3, 4] and ids(ls.LATE) == [5, 5, 6]
