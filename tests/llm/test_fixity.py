import pytest

from tidelake.llm import fixity

RECORDS = "archive long, offset long, record_id long, block binary"
PAGES = "page_id long, url string, html string"


def replica(n=400, archives=3):
    out = []
    for a in range(archives):
        at = 0
        for i in range(n):
            block = f"record {a} {i} ".encode() * (1 + i % 7)
            out.append((a, at, a * 1000 + i, block))
            at += len(block)
    return out


def run(spark, one, two, **more):
    found = fixity.audit(spark.createDataFrame(one, RECORDS), spark.createDataFrame(two, RECORDS), **more)
    return sorted((r.archive, r.offset, r.record_id, r.kind) for r in found.collect())


@pytest.mark.parametrize("span,fanout", [(64, 2), (65_536, 16)])
def test_finds_exactly_the_damage(spark, span, fanout):
    one = replica()
    two = list(one)
    a, o, i, b = one[17]
    two[17] = (a, o, i, b"X" + b[1:])
    a2, o2, i2, b2 = one[555]
    two[555] = (a2, o2, i2, b2[:-3])
    lost = two.pop(900)
    two.append((2, 10**7, 77, b"new"))
    want = sorted([(a, o, i, "changed"), (a2, o2, i2, "resized"), (*lost[:3], "missing"), (2, 10**7, 77, "extra")])
    assert run(spark, one, two, span=span, fanout=fanout) == want


def test_equal_and_empty(spark):
    one = replica(20, 1)
    assert run(spark, one, one[::-1]) == []
    assert run(spark, [], []) == []
    assert run(spark, one[:1], []) == [(0, 0, 0, "missing")]


def test_nulls_repeats_and_a_lost_archive(spark):
    one = [(0, 0, 1, None), (0, 0, 1, None), (None, 5, 2, b"x"), (0, None, 3, b"y"), (1, 0, None, b"z")]
    assert run(spark, one, one) == []
    assert run(spark, one, one[1:]) == [(0, 0, 1, "changed")]
    assert run(spark, one, one[:4]) == [(1, 0, None, "missing")]


def test_records_lie_end_to_end(spark):
    pages = spark.createDataFrame([(1, "http://a", "<p>é</p>"), (2, None, None), (None, "u", "b"), (1, "http://a", "<p>é</p>")], PAGES)
    rows = fixity.warc_records(pages, per_archive=2).collect()
    assert len(rows) == 4
    by = {}
    for r in rows:
        by.setdefault(r.archive, []).append((r.offset, len(r.block)))
    for found in by.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
    assert all(bytes(r.block).startswith(b"WARC/1.1\r\n") and bytes(r.block).endswith(b"\r\n\r\n") for r in rows)
    assert fixity.warc_records(spark.createDataFrame([], PAGES)).count() == 0
    assert fixity.levels_for(None) == 1 and fixity.levels_for(65_536 * 16) == 3
