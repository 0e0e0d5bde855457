import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, words  # noqa: F401
from lectern.llm import licences, queries, shards, urls

PAGES = "page_id long, url string, html string"
RULES = [urls.Rule("allow", "org/"), urls.Rule("block", "example.org/es/"), urls.Rule("block", "example.org/en/1"), urls.Rule("block", "com/de/")]


def verdicts(spark, rows, rules=RULES):
    df = spark.createDataFrame(rows, PAGES).select("*", F.lit(1).alias("key"), F.lit(2).alias("URL"), F.lit(3).alias("class"))
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(df, rules).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/"),
        ("https://example.org/en/19", "example.org", "/en/19", "example.org/en/1"),
        ("https://myexample.org/en/19", "myexample.org", "/en/19", "org/"),
        ("https://org/", "org", "/", "org/"),
        ("https://org", "org", "", None),
        ("x://b.com?/de/", "b.com", "", None),
        ("x://b.com/de/#://q.org/", "b.com", "/de/", "com/de/"),
        ("no scheme", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("://h.org/p", "h.org", "/p", "org/"),
        ("http://ÄB.com/de/\nx", "Äb.com", "/de/\nx", "com/de/"),
    ],
)
def test_hosts_paths_and_rules(spark, url, host, path, rule):
    found = verdicts(spark, [(1, url, None)])[1]
    assert found[:3] == (host, path, rule)
    assert found[3] == ("allow" if rule in (None, "org/") else "block")


def link(to):
    return f'<html><head><LINK rel="canonical" href="{to}"></head></html>'


def refresh(to):
    return f"<meta http-equiv='refresh' content='0; url={to}'>"


def test_blocks_spread_over_aliases(spark):
    rows = [
        (1, "http://b.com/de/a", ""),  # blocked by rule
        (2, "http://x.net/1", link("https://b.com/de/a/")),  # its canonical link
        (3, "http://x.net/2", refresh("/1.html#top")),  # a redirect to that
        (4, "https://x.net/2/?utm=1", ""),  # the same page as 3
        (5, "http://y.net/1", link("http://z.com/de/q")),  # the target is no page
        (6, "http://v.net/1", link("http://b.com/de/b")),
        (7, "http://v.net/2", link("http://v.net/1")),
        (8, "http://w.org/2", link("http://v.net/1")),  # explicitly allowed: so are 6 and 7
        (9, "http://u.net/1", None),
        (10, "http://x.net/1", ""),
        (11, None, link("http://b.com/de/a")),
        (12, "http://r.net/d/e", link("../f")),
    ]
    found = {k: v[3] for k, v in verdicts(spark, rows + rows[:1]).items()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "block", 11: "allow", 12: "allow"}


def test_links_run_over_long_chains(spark):
    rows = [(i, f"http://c.net/{i}", link(f"http://c.net/{i + 1}")) for i in range(200)] + [(200, "http://c.net/200", link("http://b.com/de/a"))]
    assert {v[3] for v in verdicts(spark, rows).values()} == {"block"}
    assert {v[3] for v in verdicts(spark, rows, []).values()} == {"allow"}
    assert verdicts(spark, []) == {}


@pytest.mark.parametrize(
    "to, target",
    [
        ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"),
        ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p#s"), ("../g", "http://a/b/g"),
        ("../..", "http://a/"), ("../../../g", "http://a/g"), ("/./g", "http://a/g"), ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."),
        ("..g", "http://a/b/c/..g"), ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g;x=1/../y", "http://a/b/c/y"),
        ("g?y/./x", "http://a/b/c/g?y/./x"), ("mailto:x", None), ("http://X.com/a/../b#c", "http://X.com/b#c"),
        ("/r?u=http://e.org/", "http://a/r?u=http://e.org/"), ("", None),
    ],
)
def test_links_are_resolved(spark, to, target):
    df = spark.createDataFrame([(to, "http://A/b/c/d;p?q")], "link string, url string")
    assert df.select(urls.absolute(F.col("link"), F.col("url"))).first()[0] == target


def test_every_link_of_a_page_counts(spark):
    rows = [
        (1, "http://x.net/1", link("http://x.net/a") + link("http://b.com/de/a")),  # the second one blocks
        (2, "http://x.net/2", refresh("c") + refresh("http://b.com/de/a")),
        (3, "http://x.net/d/3", link("../../de/./x") + link("?p=2")),
        (4, "http://x.net/d/../4", ""),  # the same page as the next one
        (5, "http://x.net/4", link("http://b.com/de/a")),
        (6, "http://x.net/6", link("mailto:a@b.com") + link("/r?u=http://b.com/de/")),
        (7, "http://b.com/en/7", link("../de/x")),  # leads to a blocked path of its own host
    ]
    found = {k: v[3] for k, v in verdicts(spark, rows).items()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "block"}


def test_urls_with_links_equal_sql(spark, tmp_path):
    from compare import connect, duckdb_bag, spark_bag

    rows = [(i, f"http://c.net/{i}", link(f"/{i + 1 if i % 7 else 900 + i}")) for i in range(60)]
    rows += [(100, "http://c.net/20", link("http://b.com/de/a")), (101, "http://c.net/d/30", refresh("x.html")), (102, "http://c.net/d/x", link("//e.org/es/")), (103, None, None)]
    rows += [(104, "http://c.net/d/f/y", link("../../5") + link("?q=/../") + link("./z/..")), (105, "http://c.net/d/../40", refresh("mailto:x") + refresh("..")), (106, "http://e.net", link("http://c.net/x/.././41") + link("/r?u=http://b.com/de/"))]
    spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(str(tmp_path / "made"))
    part = next((tmp_path / "made").glob("part-*.parquet"))
    (tmp_path / "sf").mkdir()
    part.rename(tmp_path / "sf" / "pages.parquet")
    found = spark_bag(queries.op6_url_filters(spark, str(tmp_path / "sf")))
    assert found == duckdb_bag(connect(str(tmp_path / "sf")), queries.OP6_SQL)


def check_shards(rows, n, sizes):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append((r["slot"], r["size"]))
    for own in by_shard.values():
        assert sorted(s for s, _ in own) == list(range(len(own)))
    mean = sum(sizes) / n
    totals = [sum(s for _, s in by_shard.get(k, [])) for k in range(n)]
    assert max(abs(t - mean) for t in totals) <= max(sizes)


def test_documents_in_shards(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op8_sharding(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found} == {
        i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts.items()
    }
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    check_shards(found, 24, [r["size"] for r in found])


def test_overfull_ranges_are_cut_again(spark):
    # A third of the rows is one group, and a third is one row over and over.
    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 5, id) as doc_id", "if(id % 3 = 1, 'x', string(id % 3 * id)) as text", "cast(1 + id % 97 as long) as size", "'a' as row", "1 as key"
    )
    found = shards.assigned(rows, "size", "text", shards=10, range_rows=50).collect()
    assert len(found) == 6000
    check_shards(found, 10, [r["size"] for r in found])
    # Copies lie together: in few shards, next to each other.
    assert len({r["shard"] for r in found if r["text"] == "x"}) <= 5


def test_shards_of_odd_rows(docs, words, spark):
    table = docs([(1, None), (None, ""), (2, words(20_000, 1)), (3, "a"), (3, "a")], clash=True)
    plain = table.toDF(*[f"c{i}" for i in range(len(table.columns))])
    sized = plain.select(
        F.col("c0").alias("doc_id"), F.col("c1").alias("t"), shards.byte_size(F.col("c1")).alias("size"), *[F.lit(1).alias(n) for n in ("row", "key", "range", "T", "shard", "Slot")]
    )
    found = shards.assigned(sized, "size", "t", shards=3).collect()
    assert len(found) == 5
    assert shards.assigned(sized.filter("false"), "size", "t").count() == 0
    zero = sized.withColumn("size", F.lit(0) * F.col("size"))
    assert {r["shard"] for r in shards.assigned(zero, "size", "t", shards=3).collect()} == {0}


def test_written_shards(spark, tmp_path):
    rows = spark.range(500).selectExpr("id as doc_id", "string(id) as text", "cast(8 + id % 5 as long) as size")
    placed = shards.assigned(rows, "size", "text", shards=4)
    shards.write_shards(placed, str(tmp_path / "out"), 4)
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 500


def length(vector):
    return math.sqrt(sum(x * x for x in vector.values()))


def cosine(words, other, idf):
    x, y = ({w: n * idf(w) for w, n in Counter(c).items()} for c in (words, other))
    return round(sum(x[w] * y[w] for w in x if w in y) / (length(x) * length(y)), 9) if x and y else 0.0


def places(words, run):
    return [i for i in range(len(words) - len(run) + 1) if words[i : i + len(run)] == run]


def brute_own_licence(text, idf):
    """One way after the other: identifiers, long forms, templates."""
    names, forms = licences.TEMPLATES, licences.forms()
    for found in re.findall(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)", text):
        name = re.sub(r"(-only|-or-later|\+)$", "", found)
        if name in names:
            return name
    words = licences.tokens(text)
    having = Counter(w for f in forms for w in set(licences.tokens(f.text)))
    best = (0.79999, None)
    for f in forms:
        whole, mark = licences.tokens(f.text), licences.tokens(f.mark)
        before = places(whole, licences.tokens(f.own or f.mark))[0]
        runs = [words[max(0, i - before) :][: len(whole)] for i in places(words, mark)]
        for run in runs + [words] * bool(runs):
            score = cosine(run, whole, lambda w: math.log((1 + len(forms)) / (1 + having[w])) + 1)
            best = max(best, (score, f.licence), key=lambda x: x[0])
    if best[1]:
        return best[1]
    lines = [x for x in map(licences.tokens, text.split("\n")) if x]
    scores = [(cosine(x, licences.tokens(t), idf), n) for x in lines + [words] for n, t in sorted(names.items())]
    for n, t in sorted(names.items()):
        template = licences.tokens(t)
        # No cosine is above what the words that are there have of the template.
        full = {w: k * idf(w) for w, k in Counter(template).items()}
        if length({w: x for w, x in full.items() if w in words}) < 0.8 * length(full) - 1e-9:
            continue
        ends = [i for i, w in enumerate(words) if w in full]
        scores += [
            (cosine(words[i : j + 1], template, idf), n) for i in ends for j in ends if 0 <= j - i < licences.WINDOW_SPAN * len(template)
        ]
    score, name = max(scores, key=lambda x: x[0], default=(0, None))
    return name if score >= 0.8 else None


def brute_scan(files):
    vocabulary = {w for t in licences.TEMPLATES.values() for w in licences.tokens(t)}
    df = Counter(w for _, _, t, _ in files for w in set(licences.tokens(t or "")) & vocabulary)

    def idf(w):
        return math.log((1 + len(files)) / (1 + (df[w] if w in vocabulary else 0))) + 1

    own = [brute_own_licence(text or "", idf) for _, _, text, _ in files]
    votes = defaultdict(Counter)
    for (i, path, text, flag), name in zip(files, own):
        if flag and name and path is not None:
            votes[re.sub("/?[^/]*$", "", path)][name] += 1
    out = []
    for (i, path, text, flag), name in zip(files, own):
        where = None
        if name is None and path is not None:
            d = re.sub("/?[^/]*$", "", path)
            while True:
                if d in votes:
                    where, name = d, min(votes[d], key=lambda n: (-votes[d][n], n))
                    break
                if not d:
                    break
                d = re.sub("/?[^/]*$", "", d)
        out.append((i, name, where))
    return sorted(out, key=repr)


def corpus_files(spark, sf_dir):
    files = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        i = r["doc_id"]
        last = (r["text"] or "").rstrip(" \n\r\t").rsplit("\n", 1)[-1].lower()
        notice = bool(re.search("licen[sc]e", last))
        folders = [r["source"], r["lang"], i // 1000, i // 100, i // 10][: i % 4 + 1 if notice else 5]
        files.append((i, "/".join(str(x) for x in [*folders, i]), r["text"], notice))
    return files


def test_licences_equal_brute_force(spark, sf_dir):
    files = corpus_files(spark, sf_dir)
    found = queries.op9_licences(spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["licence"], r["directory"]) for r in found), key=repr) == brute_scan(files)
    assert {"header", "directory", "none"} == {r["found_in"] for r in found}


def test_licences_come_from_every_level_above(spark):
    found = queries.op9_licences(spark, "/root/testdata/sf0.01").filter("found_in = 'directory'").collect()
    levels = Counter(r["path"].count("/") - 1 - r["directory"].count("/") for r in found)
    # 1: the file's own folder; a good part inherits from two or more levels above it.
    assert sum(n for k, n in levels.items() if k > 2) > 0.2 * len(found) > 0, levels


def test_licences_of_a_tree(spark):
    mit, gpl = licences.TEMPLATES["MIT"], licences.TEMPLATES["GPL-3.0"]
    full = {f.licence: f.text for f in licences.forms() if not f.text.startswith("This program")}
    header = next(f.text for f in licences.forms() if f.text.startswith("This program"))
    files = [
        (1, "LICENSE", mit, True), (2, "a/x.py", "import x", False), (3, "a/b/COPYING", gpl, True), (4, "a/b/c/y.py", "y = 1", None),
        (5, "a/b2/z.py", "# " + licences.TEMPLATES["Apache-2.0"] + "\nz = 2", False), (6, None, "q", True), (7, "top.py", None, False),
        (8, "a/b/c/y.py", "y = 1", None), (9, "a/b/d/e/f/g", "long " * 50_000, False), (10, "a/b/L", gpl, True), (11, "a/b/M", mit, True),
        (12, "k/cut", "This work is licensed\nunder the GNU General\nPublic License, version 3.", False),
        (13, "k/inside", "some words before it " + mit + " and some more that follow\non two lines", False),
        (14, "k/spdx", "// SPDX-License-Identifier: (MPL-2.0-only)\n" + gpl, False), (15, "k/unknown", "// SPDX-License-Identifier: ISC\nx", False),
        (16, "m/COPYING", full["MIT"], True), (17, "m/n/o/p.c", "/*\n * " + full["BSD-3-Clause"].replace("\n", "\n * ") + "*/\nint x;", False),
        (18, "m/n/q.c", "int q;", False), (19, "m/h.c", "/* " + header + " */ int h;", False), (20, "m/agpl", header.replace("GNU General", "GNU Affero General"), False),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string, is_licence_file boolean").select("*", F.lit(1).alias("folder"), F.lit(1).alias("TEXT"))
    found = licences.scan(df).collect()
    got = sorted(((r["file_id"], r["licence"], r["directory"]) for r in found), key=repr)
    assert got == brute_scan(files)
    by_id = {r["file_id"]: r for r in found}
    assert by_id[4]["licence"] == "GPL-3.0" and by_id[4]["directory"] == "a/b"
    assert [by_id[i]["licence"] for i in range(13, 20)] == ["MIT", "MPL-2.0", "MIT", "MIT", "BSD-3-Clause", "MIT", "GPL-3.0"]
    assert by_id[2]["directory"] == "" and by_id[6]["found_in"] == "none" and by_id[12]["line"] == -1
    assert licences.scan(df.filter("false")).count() == 0


WRAPPED = " * This work is licensed\n * under the GNU General\n * Public License, version 3.\n"


def found_licences(spark, texts):
    files = [(i, f"d{i}/f", t, False) for i, t in enumerate(texts)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string, is_licence_file boolean")
    return [r["licence"] for r in sorted(licences.scan(df).collect(), key=lambda r: r["file_id"])]


@pytest.mark.parametrize("before, after", [(0, 0), (0, 380), (0, 401), (500, 500), (3, 20_000)])
def test_wrapped_header_at_every_length(spark, words, before, after):
    lines = lambda n, seed: "\n".join(words(5, seed + i) for i in range(n // 5)) + "\n"
    text = lines(before, 1) + WRAPPED + lines(after, 2)
    assert found_licences(spark, [text, lines(600, 9)]) == ["GPL-3.0", None]


def test_windows_are_the_best_of_all_runs(words):
    import random

    rng = random.Random(4)
    weights = licences.Weights(licences.TEMPLATES, {"the": 40, "under": 9, "license": 3, "version": 5}, 50)
    pool = licences.tokens(licences.TEMPLATES["MIT"]) * 3 + ["x", "y", "version"]
    for _ in range(40):
        text = [rng.choice(pool) for _ in range(14)]
        single = {"MIT": weights.vectors["MIT"]}
        alone = licences.Weights.__new__(licences.Weights)
        alone.__dict__ = weights.__dict__ | {"vectors": single}
        runs = [alone.best(text[i:j])[1] for i in range(14) for j in range(i + 1, 15)]
        assert weights.windows(text, "MIT")[0] == pytest.approx(max(runs), abs=1e-9)


def test_full_licence_texts_headers_and_paragraphs(spark, words):
    from pathlib import Path

    folder = Path(licences.__file__).parent / "licence_texts"
    full = {p.stem: p.read_text() for p in folder.glob("*.txt")}
    agpl = full["GPL-3.0"].replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace("General Public", "Affero General Public")
    holder = full["MIT"].replace("<year> <copyright holders>", "2019 Some Body and others").replace("MIT License\n", "")
    header = next(f.text for f in licences.forms() if f.text.startswith("This program"))
    code = "\n".join(f"{w} = {i}" for i, w in enumerate(words(2000, 5).split()))
    prose = words(900, 6)
    cases = [
        *((text, name) for name, text in sorted(full.items())),
        (holder, "MIT"),
        ("/*\n" + "\n".join(" * " + x for x in holder.split("\n")) + "*/\n" + code, "MIT"),
        (code + "\n" + full["BSD-3-Clause"].replace("the University", "Some Body"), "BSD-3-Clause"),
        ("# " + "\n# ".join(header.split(", ")) + "\n" + code, "GPL-3.0"),
        (header.replace("GNU General", "GNU Affero General"), None),
        (agpl, None),
        (full["CC-BY-SA-4.0"].replace("-ShareAlike", ""), "CC-BY-4.0"),
        (full["CC-BY-SA-4.0"].replace("-ShareAlike", "-NonCommercial"), "CC-BY-NC-4.0"),
        (prose + " " + licences.TEMPLATES["MIT"] + " " + prose, "MIT"),
        (prose + " " + " ".join(full["MIT"].split()) + " " + prose, "MIT"),
        ("// SPDX-License-Identifier: GPL-3.0-or-later\n" + code, "GPL-3.0"),
        ("// SPDX-License-Identifier: ISC\n" + code, None),
        (code, None),
        (prose, None),
    ]
    assert found_licences(spark, [t for t, _ in cases]) == [name for _, name in cases]
