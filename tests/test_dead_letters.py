"""Dead letters hold the rejected messages whole (q42 compares their first 15 characters)."""

from collections import Counter

from airshed.plans.check_nested import messages
from airshed.streaming.validator import read_stream, route, validate
from conftest import SF_SMALL


def test_dead_letters_are_the_whole_messages(spark, tmp_path):
    src, valid, dlq, ckpt = (str(tmp_path / n) for n in ("msgs", "valid", "dlq", "ckpt"))
    sent = messages(spark, SF_SMALL).select("value")
    sent.write.text(src)
    route(read_stream(spark, "text", src), valid, dlq, ckpt).awaitTermination()
    got = Counter(r[0] for r in spark.read.schema("original_message string").json(dlq).collect())
    want = Counter(r["value"] for r in validate(sent, "value").where("status = 'invalid'").select("value").collect())
    assert got == want and max(map(len, got)) > 15
