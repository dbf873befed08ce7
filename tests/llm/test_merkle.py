"""Merkle manifest: against a plain tree in Python, tampering, odd rows."""

import hashlib
import zlib

import pytest

from stratamart.llm import common, merkle

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    if value is None:
        return "-"
    text = str(value).encode()
    return f"{len(text)}:{text.decode()}"


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row[:5]
    return digest([field(doc_id), field(source), field(lang), field(n_chars), field(text)])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def others(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 3 * 3
        out += [d for i, d in enumerate(level[first : first + 3], first) if i != at]
        at //= 3
    return out


def refold(levels, at, value):
    for level in levels[:-1]:
        first = at // 3 * 3
        value = digest([value if i == at else d for i, d in enumerate(level[first : first + 3], first)])
        at //= 3
    return value


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        trees[name] = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    levels = {name: climb([leaf_of(r) for r in trees[name]]) for name in names}
    upper = climb([levels[name][-1][0] for name in names])
    root = upper[-1][0] if names else None
    out = []
    for place, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            given = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                given = (row[0], row[1].replace("\n", ""), *row[2:])
            folded = refold(upper, place, refold(levels[name], at, leaf_of(given)))
            proof = digest(others(levels[name], at) + others(upper, place))
            out.append((row[0], leaf_of(row), levels[name][-1][0], root, proof, folded, folded == root))
    return out


def found(spark, tmp_path, rows):
    spark.createDataFrame(rows, SHAPE).write.parquet(str(tmp_path / "documents.parquet"))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in merkle.op13_merkle(spark, str(tmp_path)).select(columns).collect()]


def key(row):
    return str(row)


ODD = [
    (1, "a\nb", "en", "s", 3, "x", 7),
    (1, "a\nb", "en", "s", 3, "x", 7),
    (2, "a\nb\n", "en", "s", 3, "x", 7),
    (2, "other", "en", "s", 3, "x", 7),
    (None, "x\ny", None, None, None, None, None),
    (None, None, "de", "ß", 0, "", 0),
    (9_007_199_254_740_993, "", "de", "", 0, "", 0),
    (4, "w\n" * 50_000, "de", "s", 5, "", 0),
]


@pytest.mark.parametrize("rows", [[], ODD[:1], ODD, ODD * 3])
def test_odd_rows(spark, tmp_path, rows):
    assert sorted(found(spark, tmp_path, rows), key=key) == sorted(plain(rows), key=key)


def test_subtrees_of_several_kept_levels(spark, tmp_path, monkeypatch):
    """One source holds most rows, a third of them equal; four kept levels of nine nodes each."""
    monkeypatch.setattr(merkle, "KEPT", 2)
    monkeypatch.setattr(merkle, "SUBTREE", 9)
    monkeypatch.setattr(common, "RANGE_ROWS", 64)
    rows = [(i, f"t{i}\n", "en", "hot" if i % 10 else f"s{i % 7}", i, None, None) for i in range(820)]
    rows += [(5, "copy\n", "en", "hot", 1, None, None)] * 400
    rows += [(i, "lone", "en", f"one{i}", 1, None, None) for i in range(30)]
    assert sorted(found(spark, tmp_path, rows), key=key) == sorted(plain(rows), key=key)


def test_any_change_is_seen(spark):
    """A proof folds to the root with its own leaf only."""
    rows = spark.range(2000).selectExpr(
        "'=a' as tree", "id as doc_id", "unhex(sha2(cast(id as string), 256)) as digest"
    )
    manifest = merkle.Manifest(rows)
    assert len(manifest.kept) == 3
    proofs = manifest.proofs().collect()
    assert len(proofs) == 2000
    for p in proofs[::97]:
        path = bytes(p.route), bytes(p.siblings)
        assert merkle.fold(bytes(p.digest), *path) == manifest.root
        assert merkle.fold(bytes(32), *path) != manifest.root
