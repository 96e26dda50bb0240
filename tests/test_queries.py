"""Every query of the library runs, and equals its SQL where it has one."""

import pytest

from lexmill.registry import ORACLE, QUERIES


def plain(v):
    return round(v, 9) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(values):
    return sorted(repr(plain(tuple(r))) for r in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(set(columns)) == len(columns)
    if name in ORACLE:
        names = sorted(duck.sql(ORACLE[name]).columns)
        assert names == columns
        want = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
        assert rows(got) == rows(want)
    else:
        assert got


def test_entry(spark, sf_dir):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and out.schema == __spark_entry__.entry(spark).schema
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_partitions_do_not_matter(spark, sf_dir):
    """The same rows at one, four and thirty-two shuffle partitions."""
    seen = []
    for n in ("1", "4", "32"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append([rows(QUERIES[q](spark, sf_dir).collect()) for q in ("a01_reverse_index", "w02_islands", "k03_upsert", "j10_asof_label")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2]
