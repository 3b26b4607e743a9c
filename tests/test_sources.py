"""Text readers on tiny files."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from bindscope.operators import ledger as L
from bindscope.operators import quality as Q
from bindscope.operators import state as T
from bindscope.operators import structure as R
from bindscope.sources import confidence as C
from bindscope.sources import structures as ST
from bindscope.sources import tables as TAB
from bindscope.sources import text as TX


def pdb_line(serial, name, res, chain, seq, x, alt=" ", icode=" ", kind="ATOM  ", element="C"):
    return f"{kind}{serial:5d}  {name:<3s}{alt}{res} {chain}{seq:4d}{icode}   {x:8.3f}{0.0:8.3f}{0.0:8.3f}  1.00 50.00          {element:>2s}"


def test_pdb_model_altloc_and_residues(spark, tmp_path):
    lines = [
        "SEQRES   1 A    3  GLY UNK LEU", "MODEL        1", pdb_line(1, "CA", "GLY", "A", 5, 1.0, "B"), pdb_line(2, "CA", "GLY", "A", 5, 9.0, "A"),
        pdb_line(3, "CA", "HOH", "A", 6, 2.0), pdb_line(4, "CA", "LEU", "A", 7, 3.0, kind="HETATM"), pdb_line(5, "CA", "LEU", " ", 8, 4.0, icode="A"),
        "ENDMDL", "MODEL        2", pdb_line(1, "CA", "GLY", "A", 5, 77.0), "ENDMDL",
    ]
    (tmp_path / "a.pdb").write_text("\n".join(lines))
    atoms = ST.read_pdb_atoms(spark, str(tmp_path)).orderBy("position").collect()
    assert [(a.chain, a.auth_seq_id, a.ins_code, a.x) for a in atoms] == [("A", "5", "", 1.0), ("_", "8", "A", 4.0)]
    seq = ST.read_polymer_register(spark, str(tmp_path), "seqres").orderBy("number").collect()
    assert [(r.number, r.letter) for r in seq] == [(1, "G"), (2, "L")]


def test_mmcif_quotes_wraps_and_hydrogens(spark, tmp_path):
    text = """data_t
loop_
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.auth_asym_id
_atom_site.label_asym_id
_atom_site.label_seq_id
_atom_site.label_atom_id
_atom_site.type_symbol
1.0 2.0 3.0 X
A 4 "O5'" O
0.1 0 0 X . ? H1 H
5 6 7 Y . 9 CA C
#
loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.mon_id
_pdbx_poly_seq_scheme.auth_seq_num
A 1 GLY 11
A 2 UNK 12
A 3 LEU ?
#
"""
    (tmp_path / "t.cif").write_text(text)
    atoms = ST.read_mmcif_atoms(spark, str(tmp_path)).orderBy("position").collect()
    assert [(a.chain, a.residue, a.atom_name, a.x) for a in atoms] == [("A", 3, "O5'", 1.0), ("Y", 8, "CA", 5.0)]
    reg = ST.read_polymer_register(spark, str(tmp_path), "scheme").orderBy("number").collect()
    assert [(r.chain, r.number, r.letter, r.auth_seq_id) for r in reg] == [("A", 1, "G", "11"), ("A", 3, "L", "3")]


def test_fasta(spark):
    text = "junk\n>a x\nAC\u0000D\n EF \n\n>b\nGG\n>a x\nLAST\n>\nZZ\n>empty"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = [(r.header, r.sequence) for r in TX.read_fasta(df, "id", "t").orderBy("ordinal").collect()]
    assert got == [("a x", "LAST"), ("b", "GG"), ("empty", "")]


def test_fasta_lines(spark):
    df = spark.createDataFrame([("s1", "ac de\nfg")], "i string, s string")
    assert TX.to_fasta_lines(df, "i", "s", 4).first().value == ">s1\nACDE\nFG"
    with pytest.raises(Exception, match="not a FASTA record"):
        TX.to_fasta_lines(spark.createDataFrame([("a b", "A")], "i string, s string"), "i", "s").collect()


def test_confidence_layouts(spark):
    docs = [("af2", '{"predicted_aligned_error":[[0,1],[2,0]],"plddt":[50,60]}'), ("af3", '{"token_pair_pae":[[0,1],[2,0]],"atom_plddt":[0.5,0.6]}')]
    for layout, text in docs:
        pae, plddt = C.parse_confidence(spark.createDataFrame([("s", text)], "id string, t string"), "id", "t", layout)
        assert sorted((r.i, r.j, r.pae) for r in pae.collect()) == [(0, 0, 0.0), (0, 1, 1.0), (1, 0, 2.0), (1, 1, 0.0)]
        assert [r.plddt for r in plddt.orderBy("residue").collect()] == [50.0, 60.0]


def test_inventory_and_ranked_csv(spark, tmp_path):
    (tmp_path / "shards").mkdir()
    for name in ("shards/a.pdb", "shards/.hidden", "shards/b.tmp"):
        (tmp_path / name).write_text("x")
    inv = TAB.read_inventory(spark, str(tmp_path / "shards")).collect()
    assert [(r.path, r.size) for r in inv] == [("a.pdb", 1)]
    csv = tmp_path / "r.csv"
    csv.write_text("# campaign,target=x\nrank,candidate_id\n1,c1\n")
    assert TAB.read_ranked_csv(spark, str(csv), ["rank"]).first().candidate_id == "c1"
    with pytest.raises(ValueError, match="lacks columns: nope"):
        TAB.read_ranked_csv(spark, str(csv), ["nope"])


def test_duplicate_alias_is_an_error(spark):
    index = spark.createDataFrame([("x", "f1"), ("x", "f2")], "alias string, canonical string")
    assert L.alias_conflicts(index).count() == 1
    with pytest.raises(Exception, match="duplicate framework alias x"):
        TAB.require_unique_aliases(index).collect()


def embeddings(observed, full):
    return [c for c in itertools.combinations(range(len(full)), len(observed)) if all(full[p] == o for p, o in zip(c, observed))]


def test_unique_embedding_matches_enumeration():
    rng = random.Random(5)
    for _ in range(400):
        full = "".join(rng.choice("ABC") for _ in range(rng.randint(1, 8)))
        observed = "".join(rng.choice("ABC") for _ in range(rng.randint(1, 5)))
        found = embeddings(observed, full)
        assert R.embed_uniquely(observed, full) == (list(found[0]) if len(found) == 1 else None)


def test_selector_rules(spark):
    res = spark.createDataFrame([(1, "A", i, str(i + 11), "", str(i + 1)) for i in range(15)], "structure_id int, chain string, index bigint, auth_seq_id string, ins_code string, label_seq_id string")
    sel = spark.createDataFrame([(1, "A", 1, "12"), (1, "A", 2, "3"), (1, "A", 3, "99"), (1, "A", 4, "20-22")], "structure_id int, chain string, selector_id int, selector string")
    out = {}
    for r in R.select_residues(res, sel).collect():
        out.setdefault((r.selector_id, r.status), []).append(r["index"])
    assert out == {(1, "ambiguous"): [None], (2, "ok"): [2], (3, "unmatched"): [None], (4, "ok"): [9, 10, 11]} or sorted(out[(4, "ok")]) == [9, 10, 11]
    with pytest.raises(Exception, match="selector 1: ambiguous"):
        R.require_selected(R.select_residues(res, sel.filter("selector_id = 1"))).collect()


def test_stale_and_budget(spark):
    schema = "shard_id string, status string, heartbeat_at timestamp, attempt_count bigint, max_attempts bigint, claim_worker_id string, completed_at timestamp, error_message string"
    import datetime as dt

    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("a", "running", old, 1, 3, "w", None, None), ("b", "running", old, 3, 3, "w", None, None), ("c", "running", None, 1, 3, "w", None, None), ("d", "running", new, 1, 3, "w", None, None), ("e", "completed", old, 1, 3, None, old, None)]
    df = spark.createDataFrame(rows, schema)
    out = {r.shard_id: r for r in T.sweep_stale(df, F.lit(dt.datetime(2024, 1, 1, 12)), F.lit(new)).collect()}
    assert {k: v.status for k, v in out.items()} == {"a": "pending", "b": "failed", "c": "running", "d": "running", "e": "completed"}
    assert out["b"].error_message == "stale claim" and out["b"].completed_at == new and out["a"].claim_worker_id is None
    assert len(out) == 5


def test_gap_rules(spark):
    rows = [("A", i, n) for i, n in enumerate(["1", "2", "2", "5"])] + [("B", i, n) for i, n in enumerate(["1", "x", "9"])]
    df = spark.createDataFrame(rows, "chain string, pos int, num string")
    assert [(r.chain, r.number, r.next_number) for r in Q.check_contiguous(df, ["chain"], "pos", "num").collect()] == [("A", 2, 5)]


def test_documents_of_any_layout(spark):
    texts = [
        (1, '{"pae": [[0, 9, 1], [2, 0, 3], [4, 5, 0]], "atom_plddts": [10, 20, 30, 40], "chain_pair_iptm": [[null, 0.5], [0.25, null]], "iptm": 0.75}'),
        (2, '{"predicted_aligned_error": [[0, 7], [8, 0]], "plddt": [0.5, 1.0], "ptm": 0.5}'),
        (3, '{"pae": [[0, 7], [8, 0]], "plddt": [50, 60], "pair_chains_iptm": {"0": {"0": 0.9, "1": 0.125}, "1": {"0": 0.5, "x": 1}}}'),
        (4, "no json"), (5, '{"pae": "text", "plddt": null}'), (6, None), (7, "[1, 2]"), (8, '{"plddt": [1, "a"]}'),
    ]
    docs = C.read_documents(spark.createDataFrame(texts, "id long, t string"), "id", "t")
    assert {r.id: r.layout for r in docs.collect()} == {1: "af3", 2: "af2", 3: "boltz", 4: None, 5: "af2", 6: None, 7: None, 8: "af2"}
    # Token 1 of the first document is a ligand, with the atom 2.
    tokens = spark.createDataFrame([(1, 0, "A", 5), (1, 2, "B", 1), (2, 0, "A", 1), (2, 1, "B", 1), (3, 0, "A", 1), (3, 1, "B", 1)], "id long, token int, chain string, residue int")
    atoms = spark.createDataFrame([(1, 0, "A", 5, "N"), (1, 1, "A", 5, "CA"), (1, 3, "B", 1, "CA")], "id long, ordinal int, chain string, residue int, atom_name string")
    rows = {(r.structure_id, r.chain, r.i): (r.errors, [(s.chain, s.start, s.first) for s in r.spans]) for r in C.matrix_rows(docs, tokens, "id").collect()}
    assert rows[1, "A", 5] == ([0.0, 1.0], [("A", 0, 5), ("B", 1, 1)]) and rows[1, "B", 1][0] == [4.0, 0.0] and len(rows) == 6
    got = sorted((r.id, r.chain, r.plddt) for r in C.residue_plddt(docs, tokens, atoms, "id").collect())
    assert got == [(1, "A", 20.0), (1, "B", 40.0), (2, "A", 50.0), (2, "B", 100.0), (3, "A", 50.0), (3, "B", 60.0)]
    chains = spark.createDataFrame([(i, k, c) for i in (1, 3) for k, c in enumerate("AB")], "id long, ordinal int, chain string")
    pairs = sorted((r.structure_id, r.chain_a, r.chain_b, r.value) for r in C.chain_pair_iptm(docs, chains, "id").collect())
    assert pairs == [(1, "A", "B", 0.5), (1, "B", "A", 0.25), (3, "A", "B", 0.125), (3, "B", "A", 0.5)]
