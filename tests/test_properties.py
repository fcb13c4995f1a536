"""Property tests: parsing and the exact percentile against plain-Python references."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.functions import parse
from daybook.operators import percentile

WORDS = ["INFO", "WARN", "ERROR", "DEBUG", "FATAL", "info", "x.Y", "a:b", " ", ":", "INFOR",
         "\t", "at", "17/06/09 12:49:56", "99/13/40 25:61:61", "00/01/01 00:00:00"]
line = st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join)


LEVELS = ["INFO", "WARN", "ERROR", "DEBUG"]


def py_parse(s):
    """The grammar once more, by cutting strings."""
    shape = "".join("0" if c in "0123456789" else c for c in s[:17])
    prefix = s[:17] if shape == "00/00/00 00:00:00" else ""
    starts = sorted((s.find(lv), lv) for lv in LEVELS if lv in s)
    level = starts[0][1] if starts else ""
    comp = ""
    for i in range(len(s)):  # the first level word followed by blanks, a name and a colon
        lv = next((x for x in LEVELS if s.startswith(x, i)), None)
        if lv:
            rest = s[i + len(lv):]
            blanks = len(rest) - len(rest.lstrip(" \t\n\x0b\f\r"))
            end = rest.find(":", blanks)
            if blanks and end > blanks:
                comp = rest[blanks:end]
                break
            # A single blank may itself be the name.
            if blanks > 1 and rest[blanks:blanks + 1] == ":":
                comp = rest[blanks - 1:blanks]
                break
    t = None
    if prefix:
        try:
            t = dt.datetime(2000 + int(s[:2]), int(s[3:5]), int(s[6:8]), int(s[9:11]), int(s[12:14]), int(s[15:17]))
        except ValueError:
            t = None
    return prefix, level, comp, t


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(line, min_size=1, max_size=40))
def test_parse_matches_python(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = df.select(parse.timestamp_prefix("value"), parse.level("value"),
                    parse.component("value"), parse.log_time("value")).collect()
    assert [tuple(r) for r in got] == [py_parse(x) for x in lines]


def py_disc(values, q):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    for i, v in enumerate(xs, start=1):
        if i >= q * len(xs):
            return v


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5).map(float))),
                min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.95, 1.0]))
def test_exact_percentile_matches_definition(spark, rows, q):
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.percentile for r in percentile.exact(df, ["g"], "v", q).collect()}
    groups = {g for g, _ in rows}
    want = {g: py_disc([v for gg, v in rows if gg == g], q) for g in groups}
    want = {g: v for g, v in want.items() if v is not None}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[g], want[g]) for g in want)
