"""Merkle manifest against trees built by hand."""

import hashlib
import random
import zlib

import pytest

from regraft.llm.manifest import folded, manifest_digests, merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The top, and for each node its runs up to it as (run, place)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for path, a in zip(paths, at):
            path.append((runs[a // 8], a % 8))
        nodes, at = [h(*r) for r in runs], [a // 8 for a in at]
    return nodes[0], paths


def manifest_by_hand(rows):
    """``rows``: (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = lambda t: h(*map(field, (doc_id, source, lang, n_chars, t)))  # noqa: B023, E731
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None
        changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if tampered else text
        trees.setdefault(lang, []).append((doc_id, leaf(text), leaf(changed)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        made[lang] = climb([r[1] for r in trees[lang]])
    if not order:
        return []
    root, over = climb([made[lang][0] for lang in order])
    out = []
    for lang, above in zip(order, over):
        subroot, paths = made[lang]
        for (doc_id, leaf, changed), path in zip(trees[lang], paths):
            whole, node = path + above, changed
            beside = [x for run, at in whole for i, x in enumerate(run) if i != at]
            for run, at in whole:
                node = h(*[node if i == at else x for i, x in enumerate(run)])
            out.append((doc_id, leaf, subroot, root, h(*beside), node, node == root))
    return sorted(out, key=str)


def found(frame):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, leaf STRING, tree STRING, node BIGINT, key STRING"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)


@pytest.mark.parametrize(
    "sizes",
    [
        {"en": 1}, {"en": 8}, {"en": 9}, {None: 3, "en": 1}, {"a": 65, "b": 64, None: 63, "": 1}, {"en": 700, "de": 513},
        {f"l{k}": 1 + k % 3 for k in range(70)},
    ],
    ids=str,
)
def test_against_trees_by_hand(spark, sizes):
    draw = random.Random(5)
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i * 3, draw.choice([None, "", "text A", "ä B ", "plain", "É"]), lang, draw.choice([None, "s1", "ü"]), draw.choice([None, i])))
            i += 1
    draw.shuffle(rows)
    assert found(manifest_digests(table(spark, rows).repartition(5))) == manifest_by_hand(rows)


def test_ties_nulls_and_empty_table(spark):
    rows = [(1, "A", "en", None, None)] * 11 + [(1, "B", "en", None, None)] * 3 + [(None, "C", "en", "s", 1)] * 2 + [(None, None, None, None, None)] * 2
    assert found(manifest_digests(table(spark, rows))) == manifest_by_hand(rows)
    assert found(manifest_digests(table(spark, rows).limit(0))) == []


def test_a_very_long_text(spark):
    rows = [(3, "Xy " * 2_000_000, "en", "s", 6_000_000), (4, "z", "en", "s", 1)]
    assert found(manifest_digests(table(spark, rows))) == manifest_by_hand(rows)


def test_paths_lead_to_the_root(spark):
    rows = [(i, f"t{i}", "en" if i % 3 else "fr", "s", i) for i in range(300)]
    made = merkle_manifest(table(spark, rows), "doc_id", "lang", ["doc_id", "text"])
    checked = made.withColumn("end", folded(made["leaf"], made["path"]))
    assert checked.where("end = root AND changed_leaf IS NULL").count() == 300
    assert {len(r.path) for r in made.collect()} == {4}


def test_the_table(corpus):
    given = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in corpus[0].collect()]
    assert found(manifest_digests(corpus[0])) == manifest_by_hand(given)
