"""URL filter, chat formatting, decontamination, the pipeline, and all queries with SQL."""

import random

import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from muster.llm import chat, decontamination, minhash_dedup, queries, url_filter
from verification.compare import connect, rows_of_spark, rows_of_sql


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, folder, name):
    df = queries.registered()[name](spark, folder)
    names, expected = rows_of_sql(connect(folder), queries.statements()[name])
    assert sorted(df.columns) == names
    assert rows_of_spark(df) == expected
    assert expected.total() > 0


# URLs

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://",
    "http://NET/",
    "http://net",
    "https://a.b.example.net/en/x?q=/de/",
    "https://example.net/en",
    "https://example.net:80/en/",
    "https://myexample.net/en/",
    "ftp://EXAMPLE.com/de/://x",
    "https://example.com/DE/",
    "https://x.org/fr/#/",
    "https://x.org/france",
    "https://x.org//fr/",
    "http://x.net?://y.org/fr/",
    "http://ÄÖ.net/\n",
]
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
    ("block", "NET/x"), ("allow", "net/x"), ("block", "x.org/f"), ("allow", "x.org/fra"), ("block", "a.b.example.net/en/x"), ("allow", "net/"), ("allow", "com"),
]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = rest[:cut].translate(plain.LOWER), rest[cut:].split("?")[0].split("#")[0]
    best = (-1, -1, None, None)
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        h, p = h.translate(plain.LOWER), slash + p
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best, (h.count("."), len(p), verdict, rule))
    return host, path, best[3], best[2] or "allow"


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "id int, url string, host string, rule string")


@pytest.mark.parametrize("rules", [url_filter.RULES, RULES])
def test_urls_by_trie_and_by_joins(spark, pages, rules):
    expected = [judged(u, rules) for u in URLS]
    table = spark.createDataFrame(list(rules), "verdict string, rule string")
    for given, limit in ((list(rules), 100), (list(rules), 1), (table, 100), (table, 1)):
        found = url_filter.filter_urls(pages, given, max_broadcast=limit)
        ordered = found.orderBy("page.id").select("host", "path", "rule", "verdict").collect()
        assert list(map(tuple, ordered)) == expected


def test_no_urls(spark, pages):
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


# Chats


def test_chat_round_trip(spark):
    texts = [
        None, "", "plain", chat.OPEN + "x" + chat.CLOSE, "<\\|end|>", "<\\\\|next|> <", "[INST][/INST]", "</s>[",
        "a\\", "<<|turn|>>", "ünï 🙂",
    ]
    turns = [(1, i, ("user", "assistant", "assistant", None, "<|says|>")[i % 5], t) for i, t in enumerate(texts)]
    turns += [(None, None, "user", "x"), (None, 2, "user", "x"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same")]
    random.Random(1).shuffle(turns)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    found = chat.format_chats(df).select("conv_id", "formatted", "pieces", chat.read_back(F.col("formatted")).alias("back"))
    rows = {r.conv_id: r for r in found.collect()}
    assert set(rows) == {1, None, 3}
    for key, r in rows.items():
        mine = sorted(
            ((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == key)
        )
        assert [tuple(b) for b in r.back] == [(role, text) for _, role, text in mine]
        assert "".join(p.piece for p in r.pieces) == r.formatted
        assert sum(p.loss for p in r.pieces) == sum(role == "assistant" for _, role, _ in mine)
    assert rows[3].formatted == "<|turn|>assistant<|says|>same<|next|>same<|end|>"
    assert chat.format_chats(df.limit(0)).count() == 0


def test_marks_that_could_not_be_escaped():
    with pytest.raises(ValueError):
        chat._control(("<<x>>",))


# Decontamination


def edited(text, edits, rng):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.random()
        if kind < 0.4:
            letters[at] = "x"
        elif kind < 0.7:
            del letters[at]
        else:
            letters.insert(at, "z")
    return "".join(letters)


def test_items_with_edits(spark, documents):
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((3, 8, 15, 25, 40, 60))] + [(90, None), (91, "")]
    items.append((92, items[3][1]))
    docs = [(None, None), (0, ""), (1, text(30))]
    for i in range(2, 30):
        item = items[i % 6][1]
        docs.append((i, text(12) + "\n" + edited(item.upper(), min(i, len(item) // 6), rng) + ", " + text(9)))
    docs.append((5, docs[8][1]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = plain.contaminated(docs, [(k, t) for k, t in items])
    for limit in (1_000_000, 300):
        found = decontamination.with_matches(documents(docs), benchmark, block_chars=limit)
        rows = found.select("document.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
        assert {(r.doc_id, r.item): r.segments for r in rows} == expected
    assert len(expected) > 10
    assert decontamination.with_matches(documents([]), benchmark).count() == 0
    none = decontamination.with_matches(documents(docs), benchmark.limit(0))
    assert none.filter(F.size("matches") > 0).count() == 0


def test_partial_verbatim_quotes_at_every_offset(spark, documents):
    rng = random.Random(11)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    items = [(n, " ".join(word("etaoinsh") for _ in range(n))[:n]) for n in (60, 110, 227, 384)]
    quotes = [x[s : s + n] for _, x in items for n in (49, 50, 72, 96, 128) for s in range(len(x) - n + 1)]
    around = lambda: " ".join(word("bcdfgjkl") for _ in range(9))
    docs = [(i, f"{around()} {q.upper()}, {around()}") for i, q in enumerate(quotes)]
    plains = [(k, plain.plain_words(x)) for k, x in items]
    expected = set()
    for i, t in docs:
        t = plain.plain_words(t)
        expected |= {(i, k) for k, x in plains if any(x[s : s + 50] in t for s in range(len(x) - 49))}
    found = decontamination.with_matches(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    rows = found.select("document.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
    assert {(r.doc_id, r.item) for r in rows} == expected
    texts = {i: plain.plain_words(t) for i, t in docs}
    for r in rows:
        if not r.segments:
            assert r.edits == 0 and texts[r.doc_id][r.place : r.place + 50] in dict(plains)[r.item]
    assert len(expected) > 1500 and len(docs) > len(expected)


def test_item_much_longer_than_the_only_text(spark, documents):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("etaoinsh") for _ in range(6)) for _ in range(n))
    items = [(1, text(30)), (2, text(4200)), (3, text(30))]
    docs = [(1, edited(items[1][1][-150:], 2, rng))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.with_matches(documents(docs), benchmark)
    rows = found.select("document.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
    item, doc = items[1][1], plain.plain_words(docs[0][1])
    near = [x for x in plain.segments(item) if x[0] >= len(item) - 600]
    held = sum(plain.edit_distance(item[s : s + n], doc) <= e for s, n, e in near)
    assert {(r.doc_id, r.item): r.segments for r in rows} == {(1, 2): held} and held


def test_short_items_as_lines_and_sentences(spark, documents):
    items = [(1, "What is pi?"), (2, "3.14!"), (3, "Why not? Ask me."), (4, "WHAT, is pi"), (5, "..."), (6, None)]
    docs = [
        (1, "what IS pi"), (2, "Some text. What is pi? It is 3.14. More."), (3, "a line\n  What is pi\r\nlast"),
        (4, "Well, what is pi?"), (5, "It is 3.145. 3.14 is near."), (6, "Yes. Why not? Ask me! No."),
        (7, "why not ask me"), (8, "..."), (9, None), (10, "What is pi? What is pi?\n3.14"),
    ]
    found = decontamination.with_matches(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    rows = found.select("document.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
    pi = {(d, k, 1, 0, p) for d, p in ((1, 0), (2, 10), (3, 7), (10, 0)) for k in (1, 4)}
    assert set(map(tuple, rows)) == pi | {(6, 3, 1, 0, 4), (7, 3, 1, 0, 0), (10, 2, 1, 0, 22)}


def test_registered_decontamination(spark, folder, given):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.registered()["op7_decontamination"](spark, folder).collect()
    held = {(i, k) for i, t in given for k, x in items if plain.plain_words(x) in plain.plain_words(t)}
    assert held and held <= {(r.doc_id, r.item_id) for r in found}
    texts = dict(given)
    for r in found:
        assert plain.contaminated([(r.doc_id, texts[r.doc_id])], [i for i in items if i[0] == r.item_id])


# The pipeline


def test_pipeline_equals_the_operators_one_by_one(spark, folder, given):
    rows = [r[:2] for r in given]
    kept = {i for i, *_, k in plain.quality(rows) if k}
    rows = [r for r in rows if r[0] in kept]
    rows = [(i, t) for i, _, _, t in plain.line_dedup(rows)]
    kept = {i for i, _, _, k in plain.near_duplicates(rows, 5) if k}
    rows = [r for r in rows if r[0] in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    words = [(k, plain.plain_words(x)) for k, x in items]
    rows = [(i, t) for i, t in rows if not any(x in plain.plain_words(t) for _, x in words)]
    found = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, found.collect())) == sorted(plain.byte_bpe(rows))


def test_stages_on_edge_cases(spark, documents, edges, folder):
    docs = documents(edges)
    for name, function in corpus_pipeline.STAGES:
        for part in (docs, docs.limit(0)):
            out = function(spark, part, folder)
            assert out.count() <= part.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_one_row_of_a_group_stays_whatever_its_id(spark, documents, folder):
    """Repeated rows, rows without id and rows of one id with different texts."""
    one, two, three = (" ".join(f"{c}{j}" for j in range(50)) for c in "abc")
    given = [(1, one), (1, one), (None, one), (None, one), (None, one + " more"), (2, two), (2, three), (None, two), (None, None)]
    out = minhash_dedup.stage(spark, documents(given), folder).collect()
    assert sorted(r.text or "" for r in out if r.text != one + " more") in (["", one, two, three], ["", two, three])
    assert len(out) == 4
    out = minhash_dedup.stage(spark, documents([(7, one), (5, one), (None, one), (6, two)]), folder).collect()
    assert sorted(r.doc_id for r in out) == [5, 6]


def test_partial_quotes_with_edits_are_found_at_every_offset(spark, documents):
    """Quotes of 90 characters with two edits in their middle."""
    rng = random.Random(13)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    items = [(n, " ".join(word("etaoinsh") for _ in range(n))[:n]) for n in (110, 227, 384)]
    docs = []
    for _, x in items:
        for s in range(0, len(x) - 89, 3):
            q = list(x[s : s + 90])
            q[40], q[50] = "q", "y"
            docs.append((len(docs), f"{word('bcdfgjkl')} {''.join(q)} {word('bcdfgjkl')}"))
    found = decontamination.with_matches(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    held = found.filter(F.size("matches") > 0).count()
    assert held == len(docs) > 100
