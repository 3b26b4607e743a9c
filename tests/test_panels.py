"""Template panels, round robin over panels of any size, row rules of many tables."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from bindscope.operators import msa as A
from bindscope.operators import quality as Q
from bindscope.operators import structure as T


def test_panel_matches_every_pattern_by_brute_force(spark):
    rng = random.Random(1)
    panel = [(f"t{k}", "".join(rng.choices("ACD", k=rng.randint(0, 4))) + "{cdr1}" + rng.choice("CD") + "{cdr2}" + "".join(rng.choices("AC", k=rng.randint(0, 2))),
              {"cdr1": (1, 3), "cdr2": (0, 4)}) for k in range(40)] + [("plain", "ACDA", {})]
    chains = [(k, "".join(rng.choices("ACD", k=rng.randint(0, 25)))) for k in range(60)]
    out = A.extract_by_panel(spark.createDataFrame(chains, "id long, sequence string"), A.template_panel(spark, panel))
    got = {(r.id, r.template_id): r for r in out.collect()}
    want = {}
    for name, template, lengths in panel:
        pattern = re.compile(A.template_regex(template, lengths))
        want.update({(k, name): m for k, text in chains if (m := pattern.search(text))})
    assert set(got) == set(want) and len(want) > 100
    for key, m in want.items():
        row = got[key]
        assert row.match_start == m.start() + 1 and list(row.holes.values()) == list(m.groups())
        inside = {i for g in range(1, 1 + len(m.groups())) for i in range(m.start(g), m.end(g))}
        assert row.retained == [i + 1 for i in range(m.start(), m.end()) if i not in inside] and row.retained_length == len(row.retained)


def test_source_with_the_fewest_missing_residues(spark):
    seqs = spark.createDataFrame([("a", "XACKCX"), ("b", "ACKC"), ("c", "ACDC")], "src string, sequence string")
    panel = A.template_panel(spark, [("one", "AC{h}C", {"h": (1, 1)})])
    held = [("a", n) for n in (2, 3)] + [("b", n) for n in (1, 2, 4)] + [("c", n) for n in (1, 2, 3, 4)]
    found = A.missing_residues(A.extract_by_panel(seqs, panel), spark.createDataFrame(held, "src string, number int"), ["src"])
    assert {r.src: r.missing for r in found.collect()} == {"a": 1, "b": 0, "c": 0}
    assert A.best_source(found, ["template_id"], "missing", "src").first().src == "b"


@pytest.mark.parametrize("names", [0, 1, 3, 12_000])
def test_round_robin_over_any_panel(spark, names):
    dim = spark.createDataFrame([(f"n{k:05d}",) for k in range(names)] + [("n00000",)] * bool(names) + [(None,)], "canonical string")
    designs = spark.createDataFrame([(k, k * 7 - 20) for k in range(400)] + [(400, None)], "row long, design_index long")
    out = {r.row: r.framework for r in T.assign_round_robin(designs, dim).collect()}
    assert len(out) == 401 and out[400] is None
    assert all(out[k] == (f"n{(k * 7 - 20) % names:05d}" if names else None) for k in range(400))


def test_rules_of_many_tables(spark):
    tasks = spark.createDataFrame([("a", "completed", 1), ("b", "lost", 9), ("c", None, None)], "id string, status string, n int")
    jobs = spark.createDataFrame([(1, "ready")], "id int, status string")
    tables = {"validation_tasks": (tasks, Q.domain_rule("validation_tasks") | {"n": F.col("n") < 5}), "validation_msa_jobs": (jobs, Q.domain_rule("validation_msa_jobs"))}
    got = {(r.table_name, r.rule): (r.checked, r.broken) for r in Q.audit(tables).collect()}
    assert got == {("validation_tasks", "status"): (3, 1), ("validation_tasks", "n"): (3, 1), ("validation_msa_jobs", "status"): (1, 0)}
    ids = {"validation_tasks": F.col("id"), "validation_msa_jobs": F.col("id")}
    assert sorted(map(tuple, Q.violations(tables, ids).collect())) == [("validation_tasks", "b", "n"), ("validation_tasks", "b", "status")]
    sound = {"validation_msa_jobs": tables["validation_msa_jobs"]}
    assert Q.violations(sound, ids).count() == 0


def test_each_way_to_meet_a_panel_finds_the_same(spark):
    """Anchors alone, with last letters, or in a shuffled join; odd chains and templates included."""
    rng = random.Random(5)
    panel = [(f"t{k}", "".join(rng.choices("ACD", k=rng.randint(0, 4))) + "{x}" + rng.choice("CD") + "{y}" + "".join(rng.choices("AC", k=rng.randint(0, 3))),
              {"x": (1, 3), "y": (0, 4)}) for k in range(30)] + [("plain", "ACDA", {}), ("one", "A", {}), ("empty", "", {})]
    texts = ["".join(rng.choices("ACD", k=rng.randint(0, 25))) for _ in range(50)] + ["", "A", "AC", "\x1fACDA", "\x1fXX", "X\nACDA\n", None]
    chains = spark.createDataFrame(list(enumerate(texts)), "id long, sequence string")
    found = []
    for sent, many in ((100, 100), (100, 1), (1, 1)):
        out = A.extract_by_panel(chains, A.template_panel(spark, panel), sent=sent, many=many).collect()
        found.append(sorted((r.id, r.template_id, r.match_start, tuple(r.holes.values()), tuple(r.retained)) for r in out))
    want = {(k, name): m for name, t, lengths in panel for k, text in enumerate(texts) if text is not None and (m := re.compile(A.template_regex(t, lengths)).search(text))}
    assert [(a, b, c - 1, d) for a, b, c, d, _ in found[0]] == [(*key, m.start(), m.groups()) for key, m in sorted(want.items())]
    assert found[0] == found[1] == found[2]


def test_matches_are_not_exchanged(spark, tmp_path):
    """Matches grow with the product of chains and templates; they were exchanged to meet the observed numbers."""
    from bindscope.catalog import load

    df = load()[0]["h10_template_panel"](spark, "/root/testdata/sf0.001")
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    above = text[: text.index("locate")]
    assert "Exchange" not in above and "SortMergeJoin" not in above
