import random

import pytest
from pyspark.sql import functions as F

from parley.operators import merge
from parley.operators.merge import SPECS, EntitySpec

USERS = "id string, name string, real_name string, tz string, email string, batch string"
REACTIONS = "channel string, ts string, thread_ts string, user_id string, reaction string"


def _users(spark, *rows):
    return spark.createDataFrame([(i, n, n, None, "", b) for i, n, b in rows], USERS)


def test_insert_update_keep(spark, rows):
    master = _users(spark, ("U1", "ann", "10"), ("U2", "bob", "10"), (None, "nobody", "10"))
    incoming = _users(spark, ("U2", "bobby", "20"), ("U3", "cy", "20"), ("U3", "cy", "20"), (None, "noone", "20"))
    merged = merge.upsert(master, incoming, SPECS["user_data"])
    # The first batch seen stays, also for a user who is missing from the new batch.
    assert rows(merged, "id", "name", "batch") == [
        ("U1", "ann", "10"), ("U2", "bobby", "10"), ("U3", "cy", "20"), (None, "noone", "10"),
    ]
    assert rows(merge.insert_delta(master, incoming, SPECS["user_data"]), "id") == [("U3",)]
    updates = merge.update_delta(master, incoming, SPECS["user_data"])
    assert rows(updates, "id", "batch") == [("U2", "10"), (None, "10")]
    tagged = merge.changes(master, incoming, SPECS["user_data"])
    assert rows(merge.merge_counts(tagged)) == [("insert", 1), ("unchanged", 1), ("update", 2)]


def test_empty_sides(spark, rows):
    nothing = spark.createDataFrame([], USERS)
    some = _users(spark, ("U1", "ann", "10"), ("U1", "ann", "10"))
    spec = SPECS["user_data"]
    assert rows(merge.upsert(nothing, some, spec), "id") == [("U1",)]
    assert rows(merge.upsert(some, nothing, spec), "id") == [("U1",)]


def test_reactions_of_a_message_are_replaced_as_a_group(spark, rows):
    def table(*triples):
        return spark.createDataFrame([("C1", t, "", u, r) for t, u, r in triples], REACTIONS)

    master = table(("1", "a", "tada"), ("1", "b", "tada"), ("2", "a", "eyes"))
    incoming = table(("1", "b", "tada"), ("3", "c", "eyes"))
    merged = merge.upsert(master, incoming, SPECS["reaction_data"])
    assert rows(merged, "ts", "user_id") == [("1", "b"), ("2", "a"), ("3", "c")]


def test_upsert_twice_changes_nothing(spark, rows):
    master = _users(spark, ("U1", "ann", "10"), ("U2", "bob", "10"))
    incoming = _users(spark, ("U2", "bobby", "20"))
    once = merge.upsert(master, incoming, SPECS["user_data"])
    assert rows(merge.upsert(once, incoming, SPECS["user_data"])) == rows(once)


@pytest.mark.parametrize("unique", [True, False])
def test_replay_equals_the_fold(spark, rows, unique):
    dice = random.Random(11 + unique)
    keep = ("first",) if unique else ()
    spec = EntitySpec("t", ("a", "b"), ("a", "b", "v", "first"), keep_first=keep)
    schema = "a string, b int, v int, first string"
    batches = []
    for number in range(6):
        batch = {}
        for _ in range(dice.randrange(1, 12)):
            key = (dice.choice(["x", "y", None]), dice.randrange(3))
            values = (dice.randrange(5), f"f{number}")
            batch.setdefault(key, set())
            if unique:
                batch[key] = {values}
            else:
                batch[key].add(values)
        batches.append([(*k, *v) for k, vs in batch.items() for v in vs])
    folded = spark.createDataFrame([], schema)
    frames = []
    for number, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, schema)
        folded = spark.createDataFrame(merge.upsert(folded, frame, spec).collect(), schema)
        frames.append(frame.withColumn("batch_id", F.lit(f"{number:014d}")))
    everything = frames[0]
    for frame in frames[1:]:
        everything = everything.unionByName(frame)
    assert rows(merge.replay(everything, spec)) == rows(folded)


def test_large_key_group_is_not_gathered_in_a_window(spark):
    frame = spark.createDataFrame([], REACTIONS).withColumn("batch_id", F.lit("1"))
    plan = merge.replay(frame, SPECS["reaction_data"])._jdf.queryExecution().toString()
    assert "Window" not in plan
