"""The Merkle manifest against trees built whole, on awkward rows too."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fixtures.compare import differences, duck
from wayfunnel.llm import manifest, oracle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    said = [None if v is None else str(v) for v in values]
    return digest("-" if v is None else f"{len(v.encode())}:{v}" for v in said)


def grow(digests):
    """Root and, per leaf, the sibling digests and places from the bottom up."""
    paths, level, above = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for i, at in enumerate(above):
            run = level[at // 16 * 16 : at // 16 * 16 + 16]
            paths[i].append((at % 16, "".join(run[: at % 16] + run[at % 16 + 1 :])))
        level = [digest(level[i : i + 16]) for i in range(0, len(level), 16)]
        above = [at // 16 for at in above]
    return level[0], paths


def whole(rows):
    """Per row (doc_id, leaf, subroot, root, path), in any order."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        groups.setdefault(source, []).append((doc_id, leaf(doc_id, source, lang, n_chars, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    order = {n: sorted(groups[n], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for n in names}
    trees = {n: grow([d for _, d in order[n]]) for n in names}
    root, tops = grow([trees[n][0] for n in names])
    return [
        (doc_id, own, trees[n][0], root, path + top)
        for n, top in zip(names, tops, strict=True)
        for (doc_id, own), path in zip(order[n], trees[n][1], strict=True)
    ]


def found(frame):
    own = manifest.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    proved = manifest.manifest(frame, own, key="doc_id", group="source")
    proved = proved.withColumns(
        {
            "proof": manifest.proof_digest(F.col("witness")),
            "folded": manifest.folded(F.col("leaf"), F.col("witness")),
        }
    )
    return proved.collect()


def same(frame, rows):
    got = found(frame)
    assert all(r["folded"] == r["root"] for r in got)
    assert all(r["proof"] == digest(s["siblings"] for s in r["witness"]) for r in got)
    ours = [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["place"], s["siblings"]) for s in r["witness"]])
        for r in got
    ]
    assert sorted(map(repr, ours)) == sorted(map(repr, whole(rows)))


@pytest.mark.parametrize("size", [1, 16, 257, 4097])
def test_one_group_of_any_size(spark, size):
    rows = [(i * 7 % (size + 3), f"t{i}", "en", "s", i) for i in range(size)]
    same(spark.createDataFrame(rows, SCHEMA), rows)


def test_many_groups_and_awkward_rows(spark):
    sizes = {"a": 300, "b": 1, "": 16, None: 17, "é": 33, "-": 2}
    rows = [(i, f"{s}{i}", None, s, 5) for s, n in sizes.items() for i in range(n)]
    rows += [(i, "x", "en", f"s{i}", i) for i in range(300)]
    rows += [(None, None, None, None, None)] * 3 + [(4, "", "", "a", 0)] * 2 + [(5, "ü" * 50_000, "de", "a", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = ("tree", "position", "held", "digest", "block", "witness", "leaf", "root", "row", "tie", "t", "part")
    same(frame.withColumns({c: F.lit("clash") for c in clash}), rows)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_changed_rows_lead_elsewhere(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in queries.op11_manifest(spark, sf).collect():
        text = texts[row["doc_id"]] or ""
        changed = zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in text)
        assert row["verified"] is not changed


def test_query_is_its_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op11_manifest"
    assert not differences(spark, duck(sf), sf, queries.queries()[name], oracle.oracle_sql()[name])
