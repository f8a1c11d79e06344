import random

import pytest

from acreage.llm import lines


def plain(rows, min_sites):
    """Brute force: distinct sites per trimmed line, first place kept."""
    seen, first = {}, {}
    for d, t, s in rows:
        for i, x in enumerate((t or "").split("\n")):
            k = x.strip(" \t\n\x0b\x0c\r")
            if k:
                seen.setdefault(k, set()).update([s] if s is not None else [])
                place = (d is not None, d or 0, i)
                first[k] = min(first.get(k, place), place)
    out = []
    for d, t, s in rows:
        kept = []
        for i, x in enumerate((t or "").split("\n")):
            k = x.strip(" \t\n\x0b\x0c\r")
            if not k or len(seen[k]) < min_sites or first[k] == (d is not None, d or 0, i):
                kept.append(x)
        out.append((d, "\n".join(kept)))
    return sorted(out, key=repr)


def rows(n=150):
    r = random.Random(6)
    pool = [f"common {i}" for i in range(12)] + ["", "  ", "footer\t", " footer"]
    out = [(None, "common 1\nx", "s1"), (None, "common 2", None), (5, None, "s2"), (5, "", "s3"), (7, "common 1\ncommon 1", "s1"), (7, "common 1\ncommon 1", "s1")]
    for d in range(10, n):
        t = "\n".join(r.choice(pool[: r.randint(1, len(pool))]) if r.random() < 0.6 else f"own {d} {i}" for i in range(r.randint(1, 9)))
        out.append((d, t, f"s{r.randint(0, 9)}"))
    return out


@pytest.mark.parametrize("min_sites", [2, 5, 8])
def test_equals_brute_force(spark, min_sites):
    data = rows()
    docs = spark.createDataFrame([(*x, 1) for x in data], "doc_id bigint, text string, source string, n_lines int")
    got = lines.without_boilerplate(docs, min_sites=min_sites)
    assert got.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == plain(data, min_sites)


def test_far_lines_are_decided_by_their_sketch(spark):
    data = [(i, f"everywhere\nhere {i}", f"site {i}") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["text"] for r in lines.without_boilerplate(docs, min_sites=100).collect()}
    assert got == {i: (f"everywhere\nhere {i}" if i == 0 else f"here {i}") for i in range(400)}


def test_empty_table(spark):
    assert lines.without_boilerplate(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0


def test_input_columns_may_have_any_name(spark):
    names = ["row", "_row", "r1", "h1", "gone", "lines", "all", "doc", "pos", "a.b"]
    data = [(i, f"shared\nown {i}", f"s{i}", *[f"{n} {i}" for n in names]) for i in range(6)]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    got = lines.without_boilerplate(spark.createDataFrame(data, schema))
    assert got.columns == ["doc_id", "text", "source", *names, "n_lines", "n_removed"]
    want = [(i, t if i == 0 else f"own {i}", *rest, 2, int(i > 0)) for i, t, *rest in data]
    assert sorted(map(tuple, got.collect())) == want
