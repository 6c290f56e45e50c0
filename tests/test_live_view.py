"""The replayed display against a plain one, for slices of every size."""

import random

import pytest

from edgewatch.operators import alerts, live_view

ALERT = "src string, dst string, timestamp bigint, event_id bigint, score double, is_alert boolean"


def alert_list(n, seed, names):
    rnd = random.Random(seed)
    now, rows = 1_700_000_000, []
    for i in range(n):
        now += rnd.choice([0, 0, 1, 2])
        # ids fall while time stands still now and then, so that order needs both
        rows.append((f"a{rnd.randrange(names)}", f"b{rnd.randrange(names)}", now, i * 7919 % 10_007, rnd.random(), True))
    rows.append((None, "b0", now, 20_000, 1.0, True))
    return rows


def plain(rows, limit, flush, keys):
    shown, now = {}, None
    for src, dst, at, _, score, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        if at // flush != now:
            shown = dict(list(shown.items())[-limit:])
            now = at // flush
        for key in keys(src, dst):
            shown[key] = score
    return list(dict(list(shown.items())[-limit:]).items())


def edge(src, dst):
    return [] if src is None else [(src, dst)]


def ends(src, dst):
    return [x for x in (src, dst) if x is not None]


@pytest.mark.parametrize(("names", "limit", "flush", "slices"), [(4, 5, 1, 40), (12, 9, 7, 25), (3, 50, 1, 60), (9, 10, 1, 10**6)])
def test_display_after_all_alerts(spark, monkeypatch, names, limit, flush, slices):
    monkeypatch.setattr(live_view, "SLICE_ROWS", slices)
    rows = alert_list(400, names, names)
    raised = alerts.alert_rows(spark.createDataFrame(rows, ALERT).repartition(3)).cache()
    found = live_view.live_graph_edges(raised, limit, flush).orderBy("place").collect()
    assert [((r.source, r.target), r.score) for r in found] == plain(rows, limit, flush, edge)
    found = live_view.live_graph_nodes(raised, limit, flush).orderBy("place").collect()
    assert [r.node for r in found] == [k for k, _ in plain(rows, limit, flush, ends)]


def test_an_edge_that_left_enters_anew(spark):
    order = ["x", "y", "z", "x", "w"]
    rows = [("s", d, 100 + i, i, float(i), True) for i, d in enumerate(order)]
    raised = alerts.alert_rows(spark.createDataFrame(rows, ALERT))
    found = live_view.live_graph_edges(raised, 2).orderBy("place").collect()
    assert [(r.target, r.score) for r in found] == [("x", 3.0), ("w", 4.0)]


def test_no_alerts(spark):
    raised = alerts.alert_rows(spark.createDataFrame([], ALERT))
    assert live_view.live_graph_edges(raised).count() == 0
    assert live_view.live_graph_nodes(raised).count() == 0
