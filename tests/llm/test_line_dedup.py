"""Op 2 against a plain count of sites, and awkward rows."""

import random

import odd

import corpus_pipeline
from histwright.llm import line_dedup


def brute(rows, min_sites):
    sites = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r") and source is not None:
                sites.setdefault(line.strip(" \t\r"), set()).add(source)
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        hit = [len(sites.get(x.strip(" \t\r"), ())) >= min_sites for x in lines]
        whole = any(hit) and all(h for x, h in zip(lines, hit) if x.strip(" \t\r"))
        n = 0 if whole else sum(hit)
        out.append((doc_id, "\n".join(x for x, h in zip(lines, hit) if not h) if n else text, len(lines), n, whole))
    return out


def test_equals_plain_count(spark):
    rnd = random.Random(5)
    common = [f"footer {i}" for i in range(12)]
    rows = []
    for d in range(300):
        lines = [f"own line {d} {k} with some more words" for k in range(rnd.randint(0, 4))]
        lines += rnd.sample(common, rnd.randint(0, 3)) + rnd.choice([[], [""], ["  footer 0\t"]])
        rnd.shuffle(lines)
        # footer k is on about k + 3 sites
        lines = [x for x in lines if not x.startswith("footer") or d % 15 <= int(x.split()[1]) + 2]
        rows.append((d, "\n".join(lines), f"s{d % 15}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = line_dedup.remove_boilerplate(df, min_sites=8)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed", "left_whole").collect())) \
        == sorted(brute(rows, 8))


def test_hot_line_and_coarse_sketch_are_exact(spark):
    # A third of all rows share a line on 40 sites; with a very coarse sketch the band widens, results stay exact.
    rows = [(d, ("hot line\n" if d % 3 == 0 else f"line {d % 50}\n") + f"text of its own, number {d}, and more",
             f"s{d % 40}") for d in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup.remove_boilerplate(df, min_sites=4, lg_k=4)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed", "left_whole").collect())) \
        == sorted(brute(rows, 4))


def test_awkward_rows(spark):
    df = odd.table(spark)
    got = line_dedup.remove_boilerplate(df, min_sites=2)
    assert got.columns == [*df.columns, "n_lines", "n_removed", "left_whole"]
    key = lambda r: repr(tuple(r))
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=key)
    # Copies have no line of their own and are left whole, so nothing changes here.
    assert texts == sorted(((r[0], r[1]) for r in odd.rows()), key=key)
    assert {r.doc_id for r in got.where("left_whole").collect()} == {1, 2, 7, 8}
    assert line_dedup.remove_boilerplate(odd.none(spark)).count() == 0


def test_short_pages_lose_their_footer(spark):
    footer = "a footer line that is longer than all the rest of the page"
    rows = [(d, f"own {d}\n\n{footer}\t", "en", f"s{d % 12}", 0) for d in range(24)]
    rows += [(100 + d, f"{footer}\n \nsecond shared line of all copies", "en", f"s{d}", 0) for d in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup_stage(spark, df, "").collect()}
    assert got == {r[0]: (f"own {r[0]}\n", len(f"own {r[0]}\n")) if r[0] < 100 else (r[1], 0) for r in rows}
