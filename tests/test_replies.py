"""The reply query runs over all replies."""

from colloquy.operators import facts
from colloquy.plans import fixtures

DATA = "/root/testdata/sf0.01"


def test_all_replies_are_validated_and_invalid_ones_yield_no_facts(spark, monkeypatch):
    import __spark_entry__

    seen, by_fact = [], facts.by_fact
    monkeypatch.setattr(facts, "by_fact", lambda rows: seen.append(rows) or by_fact(rows))
    out = {r.reason: r.n for r in __spark_entry__.queries()["reply_validation"](spark, DATA).collect()}
    assert seen[0].count() == fixtures.replies(spark, DATA).count()
    assert out == {r.reason: r.n for r in by_fact(seen[0].where("case_id % 6 < 2")).groupBy("reason").count().withColumnRenamed("count", "n").collect()}
