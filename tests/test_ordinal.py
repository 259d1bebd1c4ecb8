import random

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.operators.ordinal import with_ordinal, write_ordered
from tidemark.plans.silver import stage_comments, stage_likes


def test_ordinals_are_the_sorted_places(spark, tmp_dir):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, *range(50)]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "score int, id long").repartition(5)
    due = {r: i for i, r in enumerate(sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1])), 1)}
    order = [F.col("score").desc_nulls_last(), F.col("id")]
    for parts in (1, 7):
        got = with_ordinal(df, order, partitions=parts).collect()
        assert {(r["score"], r["id"]): r["ordinal"] for r in got} == due
    table = write_ordered(df, f"{tmp_dir}/t", order)
    assert [r["ordinal"] for r in table.where("ordinal between 10 and 20").orderBy("ordinal").collect()] == list(range(10, 21))
    assert with_ordinal(df.limit(0), order).count() == 0
    same = spark.createDataFrame([("x",)] * 100, "k string")  # one hot key: numbered all the same
    assert sorted(r["ordinal"] for r in with_ordinal(same, [F.col("k")], partitions=3).collect()) == list(range(1, 101))


def test_equal_ingest_times_give_the_same_row_whatever_the_partitions(spark):
    rnd = random.Random(2)
    comments = [(f"c{k % 9}", f"p{rnd.randrange(3)}", f"u{rnd.randrange(3)}", f"text {rnd.randrange(4)}", rnd.randrange(3), "Neutral",
                 False, "2024-01-01T00:00:00", "2024-01-02T00:00:00", "s") for k in range(120)]
    likes = [(f"l{k % 9}", f"p{rnd.randrange(3)}", f"u{rnd.randrange(3)}", rnd.choice(["like", "Love"]), "2024-01-01T00:00:00",
              "2024-01-02T00:00:00", "s") for k in range(120)]
    frames = [(stage_comments, comments, "comment_id string, post_id string, user_id string, content string, like_count bigint, "
               "sentiment string, is_deleted boolean, commented_at string, ingested_at string, source_system string"),
              (stage_likes, likes, "like_id string, post_id string, user_id string, reaction_type string, liked_at string, "
               "ingested_at string, source_system string")]
    for stage, rows, ddl in frames:
        found = []
        for seed in range(4):
            random.Random(seed).shuffle(rows)
            df = spark.createDataFrame(rows, ddl).repartition(seed + 1)
            found.append(sorted(map(str, stage(df, "2024-02-01 00:00:00").collect())))
        assert all(x == found[0] for x in found) and len(found[0]) == 9


def test_latest_by_key_keeps_tombstones(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, False)], "k string, ingested_at int, gone boolean")
    assert {r["k"]: r["gone"] for r in latest_by_key(df, "k").collect()} == {"a": True, "b": False}
