"""Property test: the Spark transcript merge (W2) equals a direct, line-by-line
statement of the rules (SURVEY §3.3 step 5 as amended in §3.4) on random files."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quadrant.operators.transcripts import coalesce_transcript

LINE = re.compile(r"^([^-:]*)-([^-:]*)[^:]*:(.*)$", re.S)

times = st.sampled_from(["0.0", "1.5", "2.25", "10.0", "", " 3.0 "])
texts = st.sampled_from(["a", "b: c-d", "x y", "", " ", "é:è", "\t", "\u00a0", "l1\u2028l2", "n\u0085x", "\tt\u00a0", "c\rd"])
lines = st.one_of(
    st.builds(lambda s, e, t: f"{s}-{e} : {t}", times, times, texts),
    st.just(""),
    st.sampled_from(["noise", "no colon here", "abc :", ":x"]),
)
files = st.lists(st.lists(lines, max_size=12), min_size=1, max_size=25)


def reference(file_lines):
    """Walk the lines in order: a line whose text (after the first ':' that
    follows the time span) is non-blank opens a segment; blank-text lines and
    empty lines extend it (their non-empty end replaces the end); any other
    line is noise and ends the run, and what follows it is dropped until the
    next text line."""
    out, cur = [], None
    for raw in file_lines:
        s = raw.strip()
        m = LINE.match(s)
        if s == "":
            continue
        if m and m.group(3).strip() != "":
            if cur:
                out.append(tuple(cur))
            cur = [m.group(1).strip(), m.group(2).strip(), m.group(3).strip()]
        elif m:
            end = m.group(2).strip()
            if cur is not None and end != "":
                cur[1] = end
        else:
            if cur:
                out.append(tuple(cur))
            cur = None
    if cur:
        out.append(tuple(cur))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files)
def test_merge_matches_rules(spark, examples):
    rows = [(f"f{i}", n, line) for i, f in enumerate(examples) for n, line in enumerate(f)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "file string, line_no long, line string")
    segs, _ = coalesce_transcript(df)
    got = {}
    for r in segs.collect():
        got.setdefault(r.file, []).append((r.head_line_no, (r.start, r.end, r.text)))
    for i, f in enumerate(examples):
        expect = reference(f)
        actual = [v for _, v in sorted(got.get(f"f{i}", []))]
        assert actual == expect, (f, actual, expect)
