from collections import Counter

import pytest

from veritrail.llm import sharding


def slow_table(shards, size):
    order = [[(sharding.number(f"start:{s}") + j * (sharding.number(f"step:{s}") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    owner, turn = [None] * size, 0
    while None in owner:
        slot = next(x for x in order[turn % len(shards)] if owner[x] is None)
        owner[slot] = turn % len(shards)
        turn += 1
    return owner


def test_table_against_whole_preference_orders():
    for n, size in ((1, 2), (3, 7), (5, 101), (7, 211)):
        shards = [f"s{i}" for i in range(n)]
        table = sharding.fill_table(shards, size)
        assert table == slow_table(shards, size)
        assert max(Counter(table).values()) - min(Counter(table).values()) <= 1


def test_few_slots_change_hands():
    shards = [f"s{i}" for i in range(20)]
    before, after = sharding.fill_table(shards, 4099), sharding.fill_table(shards[:-1], 4099)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.1 * 4099


def test_weights_and_refusals():
    share = Counter(sharding.fill_table(["a", "b"], 1009, [3, 1]))
    assert abs(share[0] / 1009 - 0.75) < 0.01
    for bad in (([], 7, None), (["a", "a"], 7, None), (["a"], 8, None), (["a"], 7, [0]), (["a"] * 1, 1_000_033, None)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_shard_frame(spark, tmp_path):
    shards = ["x", "y", "z"]
    rows = [(i, "slot" * 2, 1) for i in range(300)] + [(None, None, 1), (None, "n", 2), (7, "again", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, shard string, slot int")
    got = sharding.shard(frame, shards, size=101)
    assert got.columns == ["doc_id", "shard", "slot", "_slot", "_shard_id", "_shard"]
    table = sharding.fill_table(shards, 101)
    out = got.collect()
    assert len(out) == len(rows) and all(r._shard == shards[table[r._slot]] and r._slot == sharding_slot(r.doc_id) for r in out)
    clash = sharding.shard(frame.withColumn("_slot", frame.slot), shards, size=101)
    assert clash.columns == got.columns and clash.orderBy("doc_id", "shard").collect() == got.orderBy("doc_id", "shard").collect()
    assert sharding.shard(frame.limit(0), shards).count() == 0
    sharding.write_shards(frame.drop("shard"), str(tmp_path / "out"), shards, files_per_shard=2, size=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r.shard for r in back.collect()) == Counter(r._shard for r in out)


def test_write_any_columns_and_repeated_rows(spark, tmp_path):
    rows = [(1, "s", 5, 6, {"k": i}) for i in range(3)] + [(9, "t", 0, 0, {})] * 400
    frame = spark.createDataFrame(rows, "doc_id long, shard string, _salt int, part int, m map<string, int>").repartition(8)
    path = str(tmp_path / "any")
    assert sharding.write_shards(frame, path, ["x", "y"], files_per_shard=4, size=101) == "_shard"
    back = spark.read.parquet(path)
    assert back.columns == [*frame.columns, "_shard"] and sorted(map(str, back.drop("_shard").collect())) == sorted(map(str, frame.collect()))
    assert back.where("doc_id = 9").select("_metadata.file_path").distinct().count() > 1  # one row, repeated, fills several files


def sharding_slot(key):
    return sharding.number("" if key is None else str(key)) % 101
