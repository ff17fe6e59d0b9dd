"""Distinct users from merged states against counting them."""

import random

from pyspark.sql import functions as F

from parley.operators import counts, states

SCHEMA = "channel string, user_id string, subtype string, ts string"


def _posts(spark, seed, rows, users):
    dice = random.Random(seed)
    made = [
        (dice.choice(["hot", "hot", "hot", "a", "b", None]), dice.choice([None, f"U{dice.randrange(users)}"]), dice.choice([None, None, "bot_message"]), str(i))
        for i in range(rows)
    ]
    return spark.createDataFrame(made, SCHEMA)


def test_states_of_batches_merge_to_the_count_of_all(spark, rows):
    batches = [_posts(spark, seed, 120, 50 + 40 * seed) for seed in range(3)]
    numbers, parts = None, []
    for batch in batches:
        numbers = states.number_users(batch, numbers)
        parts.append(states.user_states(batch, numbers))
    given = sorted(r["number"] for r in numbers.collect())
    assert given == list(range(len(given))), "numbers are dense"
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    want = rows(counts.users_per_channel(everything))
    for order in ((0, 1, 2), (2, 0, 1), (0, 0, 1, 2)):
        merged = states.merge_states(*[parts[i] for i in order])
        assert rows(states.users_of_states(merged)) == want
    once = states.merge_states(parts[0], parts[1])
    assert rows(states.users_of_states(states.merge_states(once, parts[2]))) == want


def test_more_users_than_a_bitmap_holds(spark, rows):
    posts = spark.range(100_000).selectExpr("if(id % 10 < 7, 'hot', 'b') AS channel", "cast(id AS string) AS user_id", "cast(null AS string) AS subtype", "'1' AS ts")
    numbers = states.number_users(posts)
    state = states.user_states(posts, numbers)
    assert state.where("channel = 'hot'").count() == 4
    assert state.select(F.max(F.octet_length("users"))).first()[0] == 4096
    assert rows(states.users_of_states(state)) == [("b", 30_000), ("hot", 70_000)]


def test_empty(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    numbers = states.number_users(nothing)
    assert numbers.count() == 0
    assert states.number_users(nothing, numbers).count() == 0
    assert states.users_of_states(states.user_states(nothing, numbers)).count() == 0
