"""What travels when documents are derived from the tables."""

import re

from contract import documents
from test_plans import SF, plan


def test_orders_travel_without_their_json_text(spark):
    # a plan names what is below it after it: the JSON text of a payment is made above the shuffle
    above, below = re.split(r"Exchange hashpartitioning\([^\n]*REPARTITION_BY_NUM", plan(documents.bronze(spark, SF)), maxsplit=1)
    assert "payment_id" in above
    assert "payment_id" not in re.split(r"Exchange|BroadcastExchange", below)[0]


def test_gathered_orders_are_not_shuffled_again(spark):
    # as for more customers than Spark broadcasts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(documents.bronze(spark, SF)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depths = [re.search(r"[A-Z]", line) for line in lines]
    gathered = next(i for i, line in enumerate(lines) if "ObjectHashAggregate" in line and "collect_list" in line)
    depth = depths[gathered].start()
    for line, found in zip(lines[gathered::-1], depths[gathered::-1]):
        if found and found.start() < depth:
            depth = found.start()
            assert not line[depth:].startswith("Exchange"), line
