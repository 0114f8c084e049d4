"""The training-data operators against brute force on small, awkward tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasteloom.llm import (
    decontaminate,
    html,
    ids,
    jaccard,
    licenses,
    linededup,
    mixing,
    quality,
    queries,
    substrings,
    tokenfiles,
    warc,
)

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, kept string"
LONG = " ".join(f"w{i}" for i in range(4000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
TEXTS = [
    (1, "Same line\nother\n same LINE \n"),
    (2, None),
    (3, ""),
    (4, " \t\n \n"),
    (5, f"start {PASSAGE} end"),
    (6, f"another start {PASSAGE} other end"),
    (6, f"another start {PASSAGE} other end"),
    (7, LONG),
    (8, LONG + " x"),
    (9, "one two"),
    (10, "ONE two"),
    (None, "same line\nnull id é 　x"),
    (11, LONG),
    (12, "a b a b a b a b " * 40),
    (13, "É é under the MIT License, Apache license and GNU General Public License\nsame line"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{(i or 0) % 4}" if i != 9 else None, 7, "clash") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_line_dedup_and_its_reversal(docs, empty, spark):
    keys = [{lower(line.strip(BLANKS)) for line in (t or "").split("\n")} - {""} for _, t in TEXTS]
    common = {k for k, n in Counter(k for ks in keys for k in ks).items() if n >= 3}
    expected = Counter()
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if lower(x.strip(BLANKS)) not in common]
        expected[i, len(lines), len(lines) - len(kept), sha("\n".join(kept))] += 1
    index = linededup.LineIndex.empty(spark, min_docs=3).insert(docs)
    assert rows(linededup.digest(index.screen(docs))) == expected
    more = index.insert(docs.filter("doc_id = 9"))
    more = more.insert(docs.filter("doc_id = 9"))
    assert rows(more.screen(docs).filter("doc_id = 9").select("n_dropped")) == {(1,): 1}
    back = more.delete(docs.filter("doc_id = 9")).delete(docs.filter("doc_id = 9"))
    assert rows(linededup.digest(back.screen(docs))) == expected
    assert rows(back.refs(spark)) == rows(index.refs(spark))
    nothing = linededup.LineIndex.empty(spark).insert(empty)
    assert nothing.screen(empty).count() == 0


def test_cuckoo_filter_holds_and_forgets():
    draw = np.random.default_rng(1)
    h1, h2 = draw.integers(-(2**63), 2**63, (2, 5000))
    found = linededup.CuckooFilter.sized(5000)
    found.insert(h1, h2)
    assert found.has(h1, h2).all()
    found.delete(h1[:2500], h2[:2500])
    assert found.has(h1[2500:], h2[2500:]).all()
    assert found.has(h1[:2500], h2[:2500]).mean() < 0.01


def test_decontamination(docs, empty, spark):
    items = [(1, "W5 w6, w7 " + " ".join(f"w{i}" for i in range(8, 30))), (2, "one TWO"), (3, None), (4, "..")]
    items += [(2, "one TWO"), (5, "mit license apache license")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for i, t in TEXTS:
        words, hit, ids = plain(t), set(), set()
        for item, text in items:
            w = plain(text)
            n = min(13, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
            at = [k for k in range(len(words) - n + 1) if n and tuple(words[k : k + n]) in windows]
            hit |= {k + j for k in at for j in range(n)}
            ids |= {str(item)} if at else set()
        dirty = bool(hit) and 20 * len(hit) >= len(words)
        expected[i, len(words), len(hit), len(ids), sha(",".join(sorted(ids))), dirty] += 1
    assert rows(decontaminate.report(docs, bench)) == expected
    assert rows(decontaminate.report(docs, bench, block_bytes=40)) == expected
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in expected.items() if not k[-1])
    longest = decontaminate.matches(docs.filter("doc_id = 7"), bench.filter("item_id = 1"))
    assert rows(longest) == {(7, "1", 5, 0, 25): 1}
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_token_files_round_trip(docs, empty, spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    files = tokenfiles.write(docs, path, file_bytes=4000)
    assert files.manifest(spark).count() > 1
    expected = Counter()
    for i, t in TEXTS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    found = tokenfiles.read(spark, files).collect()
    assert Counter((r[0], r[2], r[3]) for r in found) == expected
    found.sort(key=lambda r: r[1])
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()
    ids = [r[0] for r in found if r[0] is not None]
    assert ids == sorted(ids)
    assert tokenfiles.read(spark, tokenfiles.write(empty, path)).count() == 0


@pytest.mark.parametrize("text", [" a  b", "\n b", "x\n  y\t", "<|endoftext|> q", "a\x00b", "it's. ok,\nyes", "　 a"])
def test_encoding_of_white_space(text):
    code = tokenfiles.encoder(queries.tokenizer_path())
    ids, n = code.encode([text, "b", text])
    expected = code.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids[: n[0]].tolist() == expected == ids[-n[2] :].tolist()


@pytest.mark.parametrize("text", ["end. ", "end,  ", "a.  b", "a,  b", "end  ", "a  b", "a. b", "a, b", " a. ", "a. \nb"])
def test_encoding_of_marks_before_spaces(text):
    test_encoding_of_white_space(text)


def test_quality_counts_and_outliers(docs, empty, spark):
    found = quality.assessed(docs).drop("distance", "_row")
    expected = Counter()
    for i, t in TEXTS:
        words = spaced(t)
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        count = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if spaced(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        counts = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        expected[(i, *counts, failed, not failed)] += 1  # too few for an estimate
    assert rows(found) == expected
    assert quality.assessed(empty).count() == 0
    draw = np.random.default_rng(3)
    usual = [(i, " ".join(f"word{k}" for k in draw.integers(0, 9999, 90)), "en", "a") for i in range(400)]
    odd = [(1000 + i, " ".join(f"w{k}###" for k in draw.integers(0, 9999, 90)), "en", "a") for i in range(9)]
    table = spark.createDataFrame(usual + odd, "doc_id long, text string, lang string, source string")
    kept = quality.kept(table)
    assert kept.columns == table.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == set(range(400))


def test_quality_with_a_third_of_junk_and_in_small_groups(spark):
    draw = np.random.default_rng(4)

    def texts(first, n, form, lang, source):
        made = (" ".join(form.format(k) for k in draw.integers(0, 9999, 90)) for _ in range(n))
        return [(first + i, text, lang, source) for i, text in enumerate(made)]

    table = texts(0, 400, "word{}", "en", "a") + texts(1000, 200, "w{}###", "en", "a")
    # A source and a language of their own with twelve documents, and one with a single one.
    table += texts(2000, 11, "word{}", "xx", "b") + texts(3000, 1, "w{}###", "xx", "b")
    table += texts(4000, 1, "w{}###", "yy", None) + texts(2100, 1, "word{}", "zz", "c")
    # Fourteen symbols per hundred words, in a source that has none.
    table += [(5000, " ".join(f"word{k}" + "#" * (i % 7 == 0) for i, k in enumerate(draw.integers(0, 9999, 90))), "en", "a")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    found = quality.assessed(docs).collect()
    assert all(r["distance"] is not None for r in found)
    assert {r["doc_id"] for r in found if r["kept"]} == {*range(400), *range(2000, 2011), 2100}


def test_license_scan(docs, empty, spark):
    text = licenses.TEMPLATES[3].text
    changed = text.replace("free of charge", "free of any charge").replace("merge, ", "")
    more = spark.createDataFrame([(50, "x " + changed), (51, text[: len(text) // 3])], "doc_id long, text string")
    found = licenses.scan(docs.select("doc_id", "text").union(more))
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    expected = Counter()
    for i, t in [*TEXTS, *((r[0], r[1]) for r in more.collect())]:
        words = plain(t)
        at = [
            (k, label) for label, p in phrases.items() for k in range(len(words)) if words[k : k + len(p)] == p
        ]
        starts = [k for k, _ in at]
        labels = ",".join(sorted({label for _, label in at}))
        expected[i, len(words), len(at), min(starts, default=None), max(starts, default=None), labels] += 1
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert rows(found.select(*columns)) == expected
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in found.collect()}
    assert labels[13] == ("apache,gpl,mit", 1.0)
    assert labels[50][0] == "mit-text" and 0.8 <= labels[50][1] < 1
    assert labels[51] == ("", 0.0)
    assert licenses.scan(empty).count() == 0


def test_a_far_diagonal_does_not_cut_a_license(spark):
    """A text that repeats its own first words, or foreign ones, in its middle is still found."""
    text = licenses.TEMPLATES[3].text
    words = plain(text)
    half = len(words) // 2
    own = " ".join(words[:half] + words[:5] + words[half:])
    foreign = " ".join(words[:half] + [f"z{i}" for i in range(5)] + words[half:])
    twice = " ".join(words + ["and"] * 40 + words[:half] + words[:5] + words[half:])
    pieces = " ".join(words[:half]) + " z" * 200 + " ".join(words[half:])
    table = [(1, own), (2, foreign), (3, twice), (4, pieces), (5, " ".join(words))]
    found = licenses.scan(spark.createDataFrame(table, "doc_id long, text string"))
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in found.collect()}
    for i in (1, 2, 3, 5):
        assert labels[i][0] == "mit-text" and labels[i][1] > 0.9
    assert labels[4] == ("", 0.0)


def test_mix(docs, empty):
    found = mixing.plan(docs).collect()
    by_source = Counter()
    for i, t in TEXTS:
        by_source[None if i == 9 else f"s{(i or 0) % 4}"] += len(spaced(t))
    order = sorted((s for s in by_source if s), key=str) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped: dict = {}
    while True:
        rest, share = sum(by_source.values()) - sum(capped.values()), sum(weight[s] for s in order if s not in capped)
        new = {s: 3 * by_source[s] for s in order if s not in capped and 3 * by_source[s] < rest * weight[s] / share}
        if not new:
            break
        capped |= new
    targets = {s: capped.get(s, rest * weight[s] / share) for s in order}
    assert {(r["source_size"], round(r["target"], 6)) for r in found} <= {
        (by_source[s], round(targets[s], 6)) for s in order
    }
    assert all(r["taken"] in [r["size"] * k for k in range(4)] for r in found)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in found)
    assert mixing.plan(empty).count() == mixing.mixed(empty).count() == 0


def _sets(n):
    out = []
    for _, t in TEXTS:
        w = spaced(lower(t))
        out.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_groups(docs, empty, n, percent):
    sets = _sets(n)
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    ids = {r: [TEXTS[k][0] for k in range(len(TEXTS)) if root[k] == r and TEXTS[k][0] is not None] for r in root}
    expected = Counter((TEXTS[k][0], len(sets[k]), min(ids[root[k]], default=None)) for k in range(len(TEXTS)))
    found = jaccard.groups(docs, n, percent).select("doc_id", "n_shingles", "component_id")
    assert rows(found) == expected
    kept = jaccard.one_of_each(docs, n, percent)
    assert kept.columns == docs.columns
    assert kept.count() == len({r for k, r in enumerate(root) if sets[k]}) + sum(not s for s in sets)
    assert jaccard.groups(empty).count() == 0


def test_parity_distance_is_a_lower_bound():
    draw = np.random.default_rng(7)
    sets = [np.unique(draw.integers(0, 40_000, n).astype(np.uint64)) for n in (0, 1, 900, 1100, 5000, 9000)]
    pairs = [(a, b) for a in sets for b in sets]
    found = jaccard.parity_distances(*([jaccard.parity_map(p[i]) for p in pairs] for i in (0, 1)))
    for (a, b), apart in zip(pairs, found, strict=True):
        assert apart <= len(np.setxor1d(a, b)) and (apart == 0) == (len(a) == len(b))
    # Two unrelated long sets of one size are told apart at 90 percent.
    other = draw.integers(1 << 40, 1 << 41, 9000).astype(np.uint64)
    long = draw.integers(0, 1 << 40, 9000).astype(np.uint64)
    assert jaccard.parity_distances([jaccard.parity_map(long)], [jaccard.parity_map(other)])[0] > 2 * 9000 * 10 / 190
    assert len(jaccard.parity_distances([], [])) == 0


def test_sketch_distance_is_a_lower_bound(spark):
    rng = np.random.default_rng(11)
    rows = []
    for size in (1, 40, 148, 3000):
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for kept in (0, size // 2, size - 1, size):
            y = np.concatenate([x[:kept], rng.integers(0, 1 << 63, size - kept, dtype=np.uint64)])
            apart = len(np.setxor1d(x, y))
            rows.append((apart, jaccard.sketch(jaccard.parity_map(x)), jaccard.sketch(jaccard.parity_map(y))))
    df = spark.createDataFrame(rows, "apart long, sx array<bigint>, sy array<bigint>")
    found = df.select("apart", jaccard.sketch_distance("sx", "sy").alias("d")).collect()
    assert all(row.d <= row.apart for row in found)
    assert all(row.d == 0 for row in found if row.apart == 0)
    assert sum(row.d > 0 for row in found) > len(found) // 2


def test_jaccard_in_a_group_of_near_copies(spark):
    draw = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = base.copy()
        for k in draw.integers(0, 120, 2):
            words[k] = f"n{i}x{k}"
        texts.append(" ".join(words))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 3]) for k in range(118)} for w in map(str.split, texts)]
    root = list(range(150))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(150):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.groups(table).collect()}
    assert found == {a: find(a) for a in range(150)}


def test_gram_lists_hold_what_classes_of_similar_size_share(spark, tmp_path):
    # (cid, n, prefix): at 90 percent 9 and 10 may link, 10 and 20 may not.
    # Gram 12 stands too late in both of its classes.
    classes = [(1, 10, [6, 5]), (2, 9, [8, 6]), (3, 20, [5, 9])]
    classes += [(4, 100, [9, 10, 1, 2, 3, 4, 12]), (5, 90, [11, 10, 24, 27, 28, 12])]
    table = spark.createDataFrame(classes, "cid long, n long, prefix array<long>")
    none = ids.id_filter(table.limit(0), "cid")
    lists = jaccard.gram_lists(table, none, table.limit(0), 90, str(tmp_path / "lists"))
    found = lists.select("gram", "cid", "pos")
    assert rows(found) == Counter([(6, 1, 0), (6, 2, 1), (10, 4, 1), (10, 5, 1)])


def test_repeated_sets_are_one_class(spark, tmp_path):
    signed = [(i, i, 3, i // 2 if i < 4 else i, [i], b"m") for i in range(9)]
    schema = "doc_id long, row long, n_shingles long, cid long, prefix array<long>, map binary"
    held, bits, merged = jaccard.distinct_classes(spark.createDataFrame(signed, schema), str(tmp_path / "merged"))
    assert rows(merged.select("cid", "rep", "n")) == Counter([(0, 0, 3), (1, 2, 3)])
    once = ids.rows_passing_all(held, [("cid", bits, False)])
    assert rows(once.select("cid", "rep", "n")) == Counter([(i, i, 3) for i in range(4, 9)])


def test_one_of_each_moves_no_text_that_surely_stays(spark, monkeypatch):
    texts = ["a b c d", "a b c d", "e f g h", "i j k l", "", None]
    table = spark.createDataFrame([*enumerate(texts), (2, "e f g h")], "doc_id long, text string")
    kept = jaccard.one_of_each(table)
    assert rows(kept) == Counter([(0, "a b c d"), (2, "e f g h"), (3, "i j k l"), (4, ""), (5, None)])
    moved = []

    def watched(docs, column, shared, passes=True):
        out = ids.rows_passing(docs, column, shared, passes)
        if column == "_key" and passes:
            moved.append(out)
        return out

    monkeypatch.setattr(jaccard, "rows_passing", watched)
    jaccard.one_of_each(table)
    assert Counter(r["_c0"] for r in moved[0].collect()) == Counter([1, 2, 2])


def test_substring_dedup(docs, empty):
    words = [(i, spaced(t)) for i, t in TEXTS]
    first: dict = {}
    for i, w in words:
        for k in range(len(w) - 49):
            if i is not None:
                g = tuple(w[k : k + 50])
                first[g] = min(first.get(g, i), i)
    expected = Counter()
    for i, w in words:
        gone = {
            k + j
            for k in range(len(w) - 49)
            if i is not None and first[tuple(w[k : k + 50])] < i
            for j in range(50)
        }
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[i, len(w), len(gone), sha(kept)] += 1
    assert rows(substrings.digest(substrings.deduplicated(docs))) == expected
    assert substrings.deduplicated(empty).count() == 0


def test_automaton_against_search():
    draw = np.random.default_rng(2)
    refs = [(d, draw.integers(0, 3, 40).tolist()) for d in (5, 2, 9, 2)]
    machine = substrings.Automaton()
    for d, words in refs:
        machine.add(words, d)
    machine.finish()
    for doc in (1, 3, 6, 10):
        text = draw.integers(0, 3, 60).tolist()
        covered = set()
        for k in range(60 - 4):
            held = [d for d, w in refs for j in range(36) if w[j : j + 5] == text[k : k + 5]]
            if held and min(held) < doc:
                covered |= set(range(k, k + 5))
        spans = machine.spans(text, doc, 5)
        assert {k for a, b in spans for k in range(a, b)} == covered


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a="</p>";</script></head><body>
<header>Site name</header><nav><a href=x>Home</a></nav><div id="cookie-notice">We use cookies</div>
<p>First paragraph of the page,\n with <b>bold</b> words &amp; more of them<br>after a break.</p><p>Short.
<div class="ad">Buy now</div><p>Tail of the page that is again as long as a paragraph should be.</p>
<form><input>Name</form><section class="comments"><p>A reader said this and that, at length.</p></section>
<footer>&copy; us</footer>"""


def test_main_text(spark):
    assert html.main_text(PAGE) == (
        "First paragraph of the page, with bold words & more of them after a break. Short. "
        "Tail of the page that is again as long as a paragraph should be."
    )
    article = "<body><nav>a b</nav><article><h1>T</h1><p>To.<aside>no</aside><p>x</article><p>outside text " + "y" * 60
    assert html.main_text(article) == "T To. x"
    assert html.main_text("<!-- open <p>text") == html.main_text(None) == html.main_text("") == ""
    assert html.main_text("just text < 3 & more") == "just text < 3 & more"
    pages = spark.createDataFrame([(1, "u", PAGE), (None, None, None)], "page_id long, url string, html string")
    assert rows(html.extract(pages).select("page_id", "n_chars")) == {(1, len(html.main_text(PAGE))): 1, (None, 0): 1}
    assert html.extract(pages.limit(0)).count() == 0


def test_main_text_outside_of_marked_articles():
    card = "<article><h3>Card</h3><p>Some other story, read it here as well.</p></article>"
    paragraph = "A paragraph of the story that stands in a plain division of the page."
    story = f"<div><h1>Head</h1>{f'<p>{paragraph}</p>' * 3}</div>"
    whole = " ".join(["Head", *[paragraph] * 3])
    for page in (story + card * 9, card + story, card * 9 + story + card):
        assert whole in html.main_text(f"<body>{page}")
    # A longer article drops what is around it, and keeps its short parts.
    parted = f"<article><p>x</p><aside>no</aside>{f'<p>{paragraph}</p>' * 4}</article>"
    assert html.main_text(f"<body>{parted}{story}") == " ".join(["x", *[paragraph] * 4])
    # A shorter one stays whole beside a longer story.
    short = f"<article><p>x</p><aside>no</aside><p>{paragraph} {paragraph}</p></article>"
    assert html.main_text(f"<body>{short}{story}") == f"x {paragraph} {paragraph} {whole}"


def test_archives(spark):
    pages = [(3, "u3", "same"), (1, "u1", "same"), (1, "u1", "same"), (2, None, None), (4, "a\r\nb", "é" * 9000)]
    pages += [(None, "n", "same"), (5, "e", "")] + [(10 + i, "m", f"<p>{i}</p>" * 50) for i in range(60)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write(table)
    found = warc.read(spark, files)
    expected = Counter()
    for i, _, text in pages:
        raw = (text or "").encode()
        first = min(p for p, _, t in pages if p is not None and (t or "") == (text or ""))
        kind = ("response", None) if first == i else ("revisit", first)
        expected[i, len(raw), warc.payload_digest(raw), *kind] += 1
    assert rows(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected
    path, offset = found.filter("page_id = 4").select("path", "offset").first()
    assert dict(warc.read_records(path))[offset].endswith("é".encode() + b"\r\n\r\n")
    assert warc.read(spark, warc.write(table.limit(0))).count() == 0


def test_clashing_columns_pass_through_the_filters(docs):
    clash = docs.withColumn("_row", F.lit(1)).withColumn("count", F.lit(2)).withColumn("size", F.lit(3))
    for step in (quality.kept, jaccard.one_of_each, mixing.mixed):
        assert step(clash).columns == clash.columns


def test_quality_keeps_texts_where_they_are(spark):
    """Estimates go to the rows: no text is shuffled, and all columns come back."""
    words = [" ".join(f"w{i * 31 + j * 7}" for j in range(60 + i % 5)) for i in range(40)]
    data = [(i % 35, text, "en", "a", i) for i, text in enumerate(words)] + [(50, "short", "en", "a", 1)]
    data += data[:3] + [(None, words[0], None, None, None), (60, None, "en", "a", 2)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars int")
    found = quality.kept(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert found.columns == docs.columns
    flags = quality.assessed(docs).filter("kept").select("doc_id", "_row").collect()
    rows_kept = found.select("doc_id", F.xxhash64("text", "lang", "source").alias("_row")).collect()
    assert sorted(map(str, rows_kept)) == sorted(map(str, flags)) and len(flags) > 30
