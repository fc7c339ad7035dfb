import hashlib
from collections import Counter

import pytest
import xxhash

from accessgrid.llm import queries
from accessgrid.llm import sharding as sh

NAMES = [f"s{n}" for n in range(7)]


def test_table_is_filled_evenly():
    owner = sh.fill(NAMES, 1009)
    counts = Counter(owner)
    assert len(owner) == 1009 and set(counts) == set(range(7))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_keys_move_when_a_shard_goes():
    before, after = sh.fill(NAMES, 65537), sh.fill(NAMES[:-1], 65537)
    moved = sum(a != b for a, b in zip(before, after) if b != 6 and a != 6)
    assert moved < 0.1 * 65537


def test_turns_in_order_of_preference():
    """The claims one by one, from whole preference lists."""
    import hashlib

    slots, lists = 13, []
    for name in NAMES[:3]:
        d = hashlib.md5(name.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        lists.append([(offset + j * skip) % slots for j in range(slots)])
        assert sorted(lists[-1]) == list(range(slots))
    want, turn = {}, 0
    while len(want) < slots:
        want[next(s for s in lists[turn % 3] if s not in want)] = turn % 3
        turn += 1
    assert sh.fill(NAMES[:3], slots) == [want[s] for s in range(slots)]


def test_wrong_tables():
    for shards, slots in (([], 13), (["a", "a"], 13), (["a"], 12), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sh.fill(shards, slots)


def test_placing(odd, none, docs):
    clash = odd.withColumnRenamed("fold", "slot").withColumnRenamed("key", "shard")
    rows = sh.place(clash, "doc_id", NAMES, 1009).collect()
    assert len(rows) == odd.count()
    assert len({r["shard"] for r in rows if r["doc_id"] == 4}) == 1
    table = sh.fill(NAMES, 1009)
    assert all(r["shard"] == NAMES[table[r["slot"]]] for r in rows)
    assert sh.place(none, "doc_id", NAMES).count() == 0
    spread = Counter(r["shard"] for r in sh.place(docs.selectExpr("cast(null as long) AS doc_id", "text"), "doc_id", NAMES).collect())
    assert len(spread) == 7  # rows without key are dealt by their other values


def test_written_shards(docs, tmp_path):
    placed = sh.place(docs, "doc_id", NAMES)
    cut = sh.parts(placed, 10).groupBy("shard", "part").count().collect()
    assert len(cut) > 7
    sh.write_shards(placed, str(tmp_path / "out"), 10)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert sorted(r["doc_id"] for r in back.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_no_python_in_the_plan(docs):
    plan = sh.parts(sh.place(docs, "doc_id", NAMES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_query_returns_what_the_shards_hold(spark, sf_dir, docs):
    """Placed by brute force: the hash of the id, the table of all slots."""
    owner = sh.fill(queries.SHARDS)
    want = []
    for r in docs.collect():
        h = xxhash.xxh64_intdigest(r["doc_id"].to_bytes(8, "little", signed=True), 42)
        slot = (h - (1 << 64) if h >> 63 else h) % sh.SLOTS
        data = r["text"].encode()
        want.append((r["doc_id"], r["lang"], r["source"], r["n_chars"], slot, queries.SHARDS[owner[slot]], 0, len(data), hashlib.sha256(data).hexdigest()))
    out = queries.QUERIES["op9_sharding"](spark, sf_dir)
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_whole_rows_come_back(odd, none):
    clash = odd.withColumnRenamed("fold", "part").withColumnRenamed("key", "SHARD")
    back = sh.through_shards(clash, "doc_id", NAMES, 1009, 2)
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter(map(tuple, back.select(*own).collect())) == Counter(map(tuple, odd.select(*own).collect()))
    assert set(back.columns) == {*own, "slot", "shard", "part"}
    assert max(r["part"] for r in back.collect()) >= 1
    assert sh.through_shards(none, "doc_id", NAMES).count() == 0
