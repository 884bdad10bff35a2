import pytest
from pyspark.testing import assertDataFrameEqual

from barloom.operators import quality, repeats
from barloom.operators.clean import clean_bars, dedup_bars, dedup_repeated_bars
from barloom.operators.repeats import split_by_repeats, suspect_spans
from barloom.spec import BarSpec

SPAN = 32_768
GRID = BarSpec(interval_ms=10)


def spans(df):
    return sorted((r[0], r[1]) for r in suspect_spans(df, GRID).collect())


def test_a_sound_grid_has_no_suspects(bars):
    df = bars(*[("A", 10 * t, 1.0) for t in range(-3, 40)], ("A", 10 * SPAN, 1.0), ("B", 0, 1.0))
    assert spans(df) == []
    suspect, single = split_by_repeats(df, GRID)
    assert suspect.count() == 0 and single is df


def test_repeats_are_found_in_their_span(bars):
    far = 10 * SPAN + 50
    repeated = [("A", far, 1.0), ("A", far, 2.0), ("A", -10, 1.0), ("A", -10, 3.0)]
    df = bars(("A", 0, 1.0), ("A", 10, 1.0), ("B", far, 1.0), *repeated)
    assert spans(df) == [("A", -1), ("A", 1)]
    suspect, single = split_by_repeats(df, GRID)
    assert (suspect.count(), single.count()) == (4, 3)


def test_times_off_the_grid_are_suspect(bars):
    assert spans(bars(("A", 0, 1.0), ("A", 3, 1.0))) == [("A", 0)]
    assert suspect_spans(bars(("A", None, 1.0)), GRID).count() == 1


MESS = [
    *[("A", 10 * (t % 25), float(t)) for t in range(40)],
    *[("B", 7 * (t % 9), float(t)) for t in range(20)],
    ("A", 10 * SPAN * 3, 1.0),
    (None, 10, 1.0),
    (None, 10, 1.0),
    ("A", None, 1.0),
    ("A", None, 2.0),
]


@pytest.mark.parametrize("limit", [10**6, 10])
def test_dedup_equals_the_plain_one(bars, monkeypatch, limit):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", limit)
    df = bars(*MESS)
    assertDataFrameEqual(dedup_repeated_bars(df, GRID), dedup_bars(df, GRID))
    assertDataFrameEqual(clean_bars(df, GRID, few_repeated=True), clean_bars(df, GRID))
    assertDataFrameEqual(
        clean_bars(df, GRID, dedup_first=True, few_repeated=True), clean_bars(df, GRID, dedup_first=True)
    )


@pytest.mark.parametrize("limit", [10**6, 10])
def test_duplicates_in_the_report(bars, monkeypatch, limit):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", limit)
    df = bars(*MESS)
    expected = quality.duplicate_keys(df, GRID).count()
    assert quality.validity_report(df, GRID).first()["duplicate_count"] == expected > 20


def test_keys_are_not_shuffled(bars):
    plan = suspect_spans(bars(("A", 0, 1.0)), GRID)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
