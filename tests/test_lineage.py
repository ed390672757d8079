"""Files as read against files as logged."""

from worklens.sources.landing import lineage_check


def test_both_directions_are_reported(spark):
    read = spark.createDataFrame(
        [("a.json", 3), ("b.json", 2), ("c.json", 5)], "_arquivo string, registros bigint")
    log = spark.createDataFrame(
        [("a.json", 1), ("a.json", 2), ("b.json", 4), ("d.json", 0)],
        "_arquivo string, registros bigint")
    found = {r["_arquivo"]: r["situacao"] for r in lineage_check(read, log).collect()}
    assert found == {"a.json": "confere", "b.json": "registros diferem",
                     "c.json": "sem registro no log", "d.json": "sem arquivo"}
    assert lineage_check(read.limit(0), log.limit(0)).count() == 0
