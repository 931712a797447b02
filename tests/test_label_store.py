"""Labels in batches and keys in buckets."""

import os
import random

import pytest
from pyspark.sql import functions as F

from takepick.operators import shard
from takepick.schemas import CANDIDATE, LABEL
from takepick.sources.label_store import LabelStore

MADE = CANDIDATE + ", asr_text string, language string, error string, asr_extra string"


def made(spark, rows):
    """Labels of (id, candidate_index, error)."""
    return spark.createDataFrame([(i, c, None, None, None, None, None, None, None, e, None) for i, c, e in rows], MADE)


def test_an_empty_store(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path / "s"))
    manifest = spark.createDataFrame([("a", 0)], "id string, candidate_index int")
    assert store.begin() == 1 and not store.compact() and store.labels().collect() == [] and store.last().collect() == []
    assert store.todo(manifest).count() == 1
    assert store.labels().schema == spark.createDataFrame([], LABEL).schema
    store.append(made(spark, []), store.begin())
    assert store.compact() and store.begin() == 2 and store.last().collect() == []
    with pytest.raises(ValueError):
        LabelStore(spark, str(tmp_path), 0)
    with pytest.raises(ValueError):
        LabelStore(spark, f"{tmp_path}/[a]")


def test_batches_against_a_dictionary(spark, tmp_path):
    """Random batches, in a folder of an odd name; summed up or not, what remains is the same."""
    rng, folder = random.Random(3), str(tmp_path / "a store's, é")
    keys = [(f"k{n}", n % 2) for n in range(30)] + [("é ü", 0), ("", 1)]
    manifest = spark.createDataFrame([*keys, *keys[:3], (None, 0)], "id string, candidate_index int")
    done, seen, highest = set(), {}, 0
    for n in range(6):
        store = LabelStore(spark, folder, 4 + n)  # the number of buckets is that of the first time
        rows = [(*rng.choice(keys), rng.choice([None, "E", ""])) for _ in range(rng.randrange(1, 12))] + [(None, 0, None), ("a", None, None)]
        first = store.begin()
        assert first > highest
        store.append(made(spark, rows), first)
        for i, c, e in rows:
            if i is not None and c is not None:
                seen[i, c] = n
                done |= {(i, c)} if e is None else set()
        if rng.random() < 0.6:
            assert store.compact() and not store.compact()
        want = sorted((i or "none", c) for i, c in [*keys, *keys[:3], (None, 0)] if (i, c) not in done)
        assert sorted((r.id or "none", r.candidate_index) for r in store.todo(manifest).collect()) == want
        assert store.todo(manifest, overwrite=True).count() == manifest.count()
        highest = store.labels().agg(F.max("seq")).first()[0]
    last = {(r.id, r.candidate_index): r for r in store.last().collect()}
    assert set(last) == set(seen) and {k for k, r in last.items() if r.done} == done
    numbers = {(r.id, r.candidate_index): r.seq for r in store.labels().groupBy("id", "candidate_index").agg(F.max("seq").alias("seq")).collect()}
    assert all(r.seq == numbers[k] for k, r in last.items())
    assert len(os.listdir(f"{folder}/keys")) == 2 and {p.rsplit("-", 1)[1] for p in os.listdir(f"{folder}/keys")} == {"4"}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("takepick_keys")]


def test_what_was_cut_short_does_not_count(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path / "s"), 4)
    store.append(made(spark, [("a", 0, None)]), 1)
    store.compact()
    first = store.begin()
    store.append(made(spark, [("b", 0, None)]), first)
    os.remove(tmp_path / "s" / "batches" / f"{first:019d}-00000" / "_SUCCESS")
    manifest = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], "id string, candidate_index int")
    assert sorted(r.id for r in store.todo(manifest).collect()) == ["b", "c"] and store.begin() == first
    store.append(made(spark, [("c", 0, None)]), first)
    store.append(made(spark, [("b", 0, "E")]), first, part=1)
    store.compact()
    os.remove(tmp_path / "s" / "keys" / f"{first:019d}-4" / "_SUCCESS")  # the keys before still stand
    assert sorted(r.id for r in store.todo(manifest).collect()) == ["b"]
    assert store.compact() and sorted(r.id for r in store.todo(manifest).collect()) == ["b"] and store.begin() > first


def test_keys_are_not_shuffled(spark, tmp_path):
    store = LabelStore(spark, str(tmp_path / "s"), 8)
    for n in range(2):
        store.append(made(spark, [(f"{n}-{i}", 0, None) for i in range(50)]), store.begin())
        store.compact()
    manifest = spark.createDataFrame([(f"{n}-{i}", 0) for n in range(3) for i in range(50)], "id string, candidate_index int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        todo = store.todo(manifest)
        plan = todo._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "asr_text" not in plan
        assert plan.index("Exchange hashpartitioning") < plan.index("Bucketed: true")  # the manifest's
        assert todo.count() == 50 and shard.todo(manifest, store.labels()).count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
