from __future__ import annotations

import os
import uuid

import pytest

from storelake.llm import common, exact_dedup, mixing, packing, simhash
from storelake.llm.components import connected_components
from storelake.session import settings
from tests.llm.helpers import documents

#: As on a cluster with many shuffle partitions, which nothing merges.
MANY = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def stored(spark, monkeypatch, tmp_path):
    """Folders that the operators write, by label."""
    folders = {}

    def folder(session, label):
        folders[label] = f"{tmp_path}/{label}-{uuid.uuid4().hex}"
        return folders[label]

    monkeypatch.setattr(common, "new_folder", folder)
    return lambda label: sum(f.startswith("part-") for f in os.listdir(folders[label]))


def rows_of(n):
    return [(i, f"some words of {i % (n // 2)} and more", "abc"[i % 3]) for i in range(n)]


def test_small_tables_are_few_files(spark, stored):
    docs = documents(spark, rows_of(400))
    with settings(spark, MANY):
        assert simhash.drop_near_copies(docs).count() <= 200
        once = exact_dedup.drop_copies(docs)
        assert once.count() == 200
        assert once.rdd.getNumPartitions() <= common.LEAST_TASKS + 40
        assert mixing.mixed_rows(docs).rdd.getNumPartitions() <= common.LEAST_TASKS
        placed = packing.pack(docs)
        assert placed.count() == 400 and placed.rdd.getNumPartitions() <= common.LEAST_TASKS
    for label in (
        "simhash-nodes", "simhash-blocks", "simhash-roots", "simhash-away", "simhash-pivots",
        "dedup-groups", "pack-counts",
    ):
        assert stored(label) <= common.LEAST_TASKS, label


def test_star_rounds_are_few_tasks(spark):
    links = spark.range(500).selectExpr("id AS a", "id + 1 AS b")
    with settings(spark, MANY):
        found = connected_components(links, 500)
        assert found.where("root = 0").count() == 501
        # The state of the last round is read as it is, and once more after a shuffle.
        assert found.rdd.getNumPartitions() <= common.LEAST_TASKS + 40


def test_tasks_follow_rows(spark):
    many = spark.range(0, 100, 1, 64)
    assert common.few_tasks(many, 100).rdd.getNumPartitions() == common.LEAST_TASKS
    assert common.few_tasks(many, 20 * common.ROWS_A_TASK).rdd.getNumPartitions() == 20
    assert common.few_tasks(many, 20 * 50, 50).rdd.getNumPartitions() == 20
    assert common.few_tasks(many, 10**9).rdd.getNumPartitions() == 64
