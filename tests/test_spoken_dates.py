from datetime import date

import pytest

from marquee.functions import spoken_dates

REF = date(2026, 9, 28)  # a Monday


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Fri 2 October 2026, 7pm", ("2026-10-02T19:00:00", None)),
        ("Friday 2nd Oct 7.30pm - late", ("2026-10-02T19:30:00", None)),
        ("October 5, 2026 at 18:30", ("2026-10-05T18:30:00", None)),
        ("3-5 Oct", ("2026-10-03", "2026-10-05")),
        ("28 Sep – 4 Oct 2026", ("2026-09-28", "2026-10-04")),
        ("30 Dec to 2 Jan 2027", ("2026-12-30", "2027-01-02")),
        ("until 5 Oct", ("2026-09-28", "2026-10-05")),
        ("until 5 Sep 2026", (None, None)),
        ("tomorrow 8am", ("2026-09-29T08:00:00", None)),
        ("Thu 1", ("2026-10-01", None)),
        ("Thursday 7pm", ("2026-10-01T19:00:00", None)),
        ("next Monday", ("2026-10-05", None)),
        ("3/10/2026 noon", ("2026-10-03T12:00:00", None)),
        ("2026-10-09", ("2026-10-09", None)),
        ("15 Jan", ("2027-01-15", None)),
        ("1 Sep", ("2026-09-01", None)),
        ("every Friday 7pm", (None, None)),
        ("Fridays in October", (None, None)),
        ("31 Feb 2026", (None, None)),
        ("soon", (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_parse(text, want):
    assert spoken_dates.parse(text, REF) == want


def test_column(spark):
    df = spark.createDataFrame([("3-5 Oct",), (None,)], "t string")
    assert [tuple(r[0]) for r in df.select(spoken_dates.column(REF)("t")).collect()] == [("2026-10-03", "2026-10-05"), (None, None)]
