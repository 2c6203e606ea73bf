"""Op 3: roots against hashlib, the audit against a plain comparison, awkward rows."""

import hashlib

from histwright.llm import warc_fixity as wf


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def replica(spark, rows):
    return spark.createDataFrame(rows, "file long, offset long, length long, digest string")


def records(n=400, files=3):
    out, at = [], [0] * files
    for i in range(n):
        f, length = i % files, 50 + 37 * i % 900
        out.append((f, at[f], length, sha(f"record {i}")))
        at[f] += length
    return out


def brute_root(rows, file, leaf, fanout, depth):
    nodes = {}
    for f, off, length, digest in sorted(rows):
        if f == file:
            nodes.setdefault(off // leaf, []).append(f"{off}:{length}:{digest}")
    level = {k: sha("|".join(v)) for k, v in nodes.items()}
    for _ in range(depth):
        up = {}
        for k in sorted(level):
            up.setdefault(k // fanout, []).append(f"{k}:{level[k]}")
        level = {k: sha("|".join(v)) for k, v in up.items()}
    return level


def test_tree_equals_hashlib(spark):
    rows = records()
    levels = wf.tree(replica(spark, rows), 512, 4, 5)
    got = {(r.file, r.node): r.hash for r in levels[5].collect()}
    assert got == {(f, k): h for f in range(3) for k, h in brute_root(rows, f, 512, 4, 5).items()}


def test_audit_finds_all_damage(spark):
    rows = records()
    changed = {5, 77, 78, 399}
    gone = {9, 200}
    b = [(f, o, n, sha("bad") if i in changed else d) for i, (f, o, n, d) in enumerate(rows) if i not in gone]
    b.append((1, 10**6, 10, sha("new")))
    got = {(r.file, r.offset): r.status for r in wf.audit(replica(spark, rows), replica(spark, b), 512, 4).collect()}
    want = {rows[i][:2]: "changed" for i in changed} | {rows[i][:2]: "missing" for i in gone}
    assert got == want | {(1, 10**6): "extra"}
    assert wf.audit(replica(spark, rows), replica(spark, rows), 512, 4).count() == 0


def test_awkward_replicas(spark):
    rows = [(1, 0, 5, None), (1, 0, 5, "x"), (2, 10**12, 1, "y")]
    assert wf.audit(replica(spark, rows), replica(spark, rows)).count() == 0
    assert {r.status for r in wf.audit(replica(spark, rows), replica(spark, [])).collect()} == {"missing"}
    assert {r.status for r in wf.audit(replica(spark, []), replica(spark, rows)).collect()} == {"extra"}
    assert wf.audit(replica(spark, []), replica(spark, [])).count() == 0


def test_catalogue_is_gapless_and_splits_hot_pages(spark):
    rows = [(7, "same", 100)] * 300 + [(None, "none", 40)] * 20 + [(i, f"d{i}", 10 + i) for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, digest string, length long")
    got = wf.catalogue(wf.numbered_copies(df), file_bytes=4000).collect()
    assert len(got) == len(rows)
    files = {}
    for r in got:
        files.setdefault(r.file, []).append((r.offset, r.length, r.page_id))
    for f in files.values():
        at = 0
        for off, n, _ in sorted(f, key=lambda x: x[:2]):
            assert off == at
            at += n
    assert len({r.file for r in got if r.page_id == 7}) > 3
    assert wf.catalogue(wf.numbered_copies(df.limit(0))).count() == 0
