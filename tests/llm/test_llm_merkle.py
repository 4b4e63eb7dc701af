"""Merkle manifest against a plain version."""

import hashlib
import random
import zlib

import pytest

from llm_cases import none, odd, odd_rows, rows_of
from opsframe.llm import merkle
from opsframe.llm.merkle import manifest


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def leaf(doc_id, text, lang, source, n_chars):
    return H("".join(enc(v) for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    """All levels of a list of digests, bottom first."""
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([H("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return out


def steps(lv, at):
    found = []
    for level in lv[:-1]:
        sib = at ^ 1
        found.append((level[sib] if sib < len(level) else None, at % 2 == 0))
        at //= 2
    return found


def fold(start, path):
    for sib, left in path:
        start = H(start) if sib is None else H(start + sib) if left else H(sib + start)
    return start


def plain(rows):
    by = {}
    for r in rows:
        doc_id, text, lang, source, n_chars = r[:5]
        by.setdefault(lang, []).append(r)
    key = lambda g: (g is not None, (g or "").encode())
    langs = sorted(by, key=key)
    trees, subroots = {}, []
    for g in langs:
        ordered = sorted(
            by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5]))
        )
        lv = levels([leaf(*r[:5]) for r in ordered])
        trees[g] = (ordered, lv)
        subroots.append(lv[-1][0])
    top = levels(subroots)
    out = []
    for gi, g in enumerate(langs):
        ordered, lv = trees[g]
        for i, r in enumerate(ordered):
            path = steps(lv, i) + steps(top, gi)
            doc_id, text, lang, source, n_chars = r[:5]
            tampered = (
                doc_id is not None
                and n_chars is not None
                and zlib.crc32(str(doc_id).encode()) % 7 == 0
            )
            t = leaf(doc_id, text, lang, source, n_chars + 1 if tampered else n_chars)
            out.append(
                dict(
                    doc_id=doc_id,
                    leaf=lv[0][i],
                    subroot=lv[-1][0],
                    root=top[-1][0],
                    proof_sha256=H("".join(s for s, _ in path if s is not None)),
                    folded_root=fold(t, path),
                    verified=fold(t, path) == top[-1][0],
                )
            )
    return out


def key(r):
    return (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"])


def check(df, rows):
    found = sorted(
        (
            {k: r[k] for k in ("doc_id", "leaf", "subroot", "root",
                               "proof_sha256", "folded_root", "verified")}
            for r in rows_of(df)
        ),
        key=key,
    )
    assert found == sorted(plain(rows), key=key)


def test_odd_rows(spark):
    check(manifest(odd(spark)), odd_rows())


def test_empty(spark):
    assert manifest(none(spark)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 10])
def test_many_groups_and_stages(spark, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block)
    rng = random.Random(block)
    langs = [None, "en", "de", "fr", "ü", "z", "a"]
    rows = [
        (i, "t" * rng.randint(0, 5), rng.choice(langs[: 2 + i % 5]), "s", i % 9)
        for i in range(rng.randint(40, 70))
    ]
    rows.append((7, "single", "only-me", None, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string,"
                               " source string, n_chars long")
    check(manifest(df), rows)


def test_one_row(spark):
    rows = [(3, "x", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string,"
                               " source string, n_chars long")
    (r,) = rows_of(manifest(df))
    assert r["leaf"] == r["subroot"] == r["root"]
    check(manifest(df), rows)


def test_no_python_on_rows(spark, plan_of):
    plan = plan_of(manifest(odd(spark)))
    assert "Python" not in plan and "ArrowEval" not in plan
