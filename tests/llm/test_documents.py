"""Corpus operators on the smallest documents and on edge cases, against brute force."""

import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from muster.llm import (
    byte_bpe,
    line_dedup,
    minhash_dedup,
    quality_rules,
    queries,
    sharding,
    substring_dedup,
    token_counts,
)

def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def pairs(found):
    return sorted(found, key=repr)


# The operators under one roof: a DataFrame of documents to comparable rows


def of_substrings(df):
    kept = F.sha2("words.kept", 256)
    return substring_dedup.remove_repeats(df).select("document.doc_id", "words.n_words", "words.n_removed", kept)


def of_lines(df):
    return line_dedup.dedup_lines(df).select("document.doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept")


def of_tokens(df):
    return token_counts.count_tokens(df).select("document.doc_id", "n_bytes", "n_tokens", "over_limit")


def of_ids(df):
    found = byte_bpe.encode_documents(df).select("document.doc_id", "bpe.*")
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def of_quality(df):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return quality_rules.with_quality(df).select("document.doc_id", *names)


def of_groups(words):
    return lambda df: minhash_dedup.near_duplicates(df, words=words)



def grouped(words):
    def expected(given):
        named = [(i, t) for i, t in given if i is not None]
        alone = [(None, len(plain.shingles(t, words)), None, True) for i, t in given if i is None]
        return plain.near_duplicates(named, words) + alone

    return expected


CASES = {
    "substring_dedup": (of_substrings, plain.substring_dedup),
    "line_dedup": (of_lines, plain.line_dedup),
    "token_counts": (of_tokens, plain.token_counts),
    "byte_bpe": (of_ids, plain.byte_bpe),
    "quality": (of_quality, plain.quality),
    "groups_of_2": (of_groups(2), grouped(2)),
    "groups_of_5": (of_groups(5), grouped(5)),
}


@pytest.mark.parametrize("name", CASES)
def test_smallest_documents(spark, documents, given, name):
    operator, expected = CASES[name]
    assert rows(operator(documents(given))) == pairs(expected(given))


@pytest.mark.parametrize("name", CASES)
def test_edge_cases(spark, documents, edges, name):
    operator, expected = CASES[name]
    assert rows(operator(documents(edges))) == pairs(expected(edges))


@pytest.mark.parametrize("name", CASES)
def test_empty_table(spark, documents, name):
    assert rows(CASES[name][0](documents([]))) == []


QUERIES = {
    "op1_substring_dedup": plain.substring_dedup,
    "op4_minhash_dedup": lambda given: plain.near_duplicates(given, 2),
    "op5_line_dedup": lambda given: [(i, n, d, plain.sha(t)) for i, n, d, t in plain.line_dedup(given)],
    "op6_token_counts": plain.token_counts,
    "op9_byte_bpe": plain.byte_bpe,
    "op10_quality_rules": plain.quality,
}


@pytest.mark.parametrize("name", QUERIES)
def test_registered_query(spark, given, folder, name):
    found = queries.registered()[name](spark, folder)
    width = len(QUERIES[name](given[:1])[0])
    assert rows(found.select(*found.columns[:width])) == pairs(QUERIES[name](given))


# Substrings


def test_repeats_inside_one_text_and_over_word_runs(documents):
    base = [f"a{j}" for j in range(30)]
    texts = [(1, " ".join(base + base)), (2, "\n".join(base[5:26])), (3, " ".join(base[:19])), (4, "x " * 45)]
    assert rows(of_substrings(documents(texts))) == pairs(plain.substring_dedup(texts))


def test_many_overlapping_copies(documents):
    """Passages cut at every place, so that anchors branch."""
    base = [f"a{j}" for j in range(60)]
    texts = [(i, " ".join([f"b{i}", *base[i % 17 : 60 - i % 13], f"c{i}"])) for i in range(50)]
    assert rows(of_substrings(documents(texts))) == pairs(plain.substring_dedup(texts))


# Near duplicates


def test_chain_of_links(documents):
    """Each text is near the next only: one component through all, whatever the bucket's centre."""
    words = [f"w{j}" for j in range(140)]
    texts = [(100 - i, " ".join(words[2 * i : 2 * i + 40])) for i in range(40)]
    found = rows(of_groups(2)(documents(texts)))
    assert found == pairs(plain.near_duplicates(texts, 2))
    assert {c for _, _, c, _ in found} == {61}


def test_exactly_at_the_threshold(documents):
    sets = {1: "a b c d e f g h i", 2: "a b c d e f g h", 3: "q r s t u", 4: "q r s t x"}
    found = dict((i, c) for i, _, c, _ in rows(of_groups(2)(documents(list(sets.items())))))
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    assert minhash_dedup.components(edges).filter("component <> 0").count() == 0


# Sharding


@pytest.mark.parametrize("many", [1, 5, 24])
def test_shards(spark, documents, given, edges, many):
    for texts in (given, edges, []):
        found = rows(sharding.shard(documents(texts), many))
        plain_rows = sorted(
            ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts),
            key=lambda r: (r[0] is not None, r[0] or 0, r[2]),
        )
        total, before, slots, expected = sum(r[1] for r in plain_rows), 0, {}, []
        for i, size, crc in plain_rows:
            shard = (2 * before + size) * many // (2 * total)
            slots[shard] = slots.get(shard, -1) + 1
            expected.append((i, size, crc, "bytes", shard, slots[shard], None))
            before += size
        assert found == pairs(expected)
        if texts is given:
            sizes = [sum(r[1] for r in found if r[4] == s) for s in range(many)]
            assert max(sizes) - min(sizes) <= 2 * max(r[1] for r in found)


# Quality


def test_filtering_stage_equals_the_verdicts(spark, documents, given):
    stage = quality_rules.stage(spark, documents(given), "")
    kept = {i for i, *_, k in plain.quality(given) if k}
    assert stage.columns == documents(given).columns
    assert {r.doc_id for r in stage.collect()} == kept


# Tokens


def test_round_trip_of_bytes(documents, edges):
    found = byte_bpe.encode_documents(documents(edges)).select("document.text", "bpe.ids").collect()
    ranks = byte_bpe.read_ranks(byte_bpe.VOCABULARY)
    codec = byte_bpe.Codec(byte_bpe.serialise(ranks), sorted(ranks.values()))
    assert all(codec.decode(r.ids).decode() == (r.text or "") for r in found)


def test_every_code_point_splits_as_in_the_library():
    from tokenizers import Tokenizer

    from muster.llm.pretokens import splitter

    library = Tokenizer.from_file(token_counts.VOCABULARY).pre_tokenizer
    split = splitter(token_counts.public_tokenizers.PATTERN)
    for block in range(0, 0x110000, 64):
        points = [chr(c) for c in range(block, block + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}{c}1 {c}a!{c}" for c in points)
        ends = [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        assert [t for tokens in split(text) for t in tokens] == ends


def test_every_letter_and_number_encodes_as_in_the_library():
    import regex

    from muster.llm.pretokens import splitter

    ranks = byte_bpe.read_ranks(byte_bpe.VOCABULARY)
    codec = byte_bpe.Codec(byte_bpe.serialise(ranks), sorted(ranks.values()))
    split = splitter(token_counts.public_tokenizers.PATTERN)
    points = regex.findall(r"[\p{L}\p{N}\s]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
    texts = ["".join(f"a{c}1{c} {c}!{c}" for c in points[i : i + 4000]) for i in range(0, len(points), 4000)]
    for (_, n, _, _), text in zip(plain.byte_bpe(list(enumerate(texts))), texts, strict=True):
        assert sum(map(len, codec.encode([t for tokens in split(text) for t in tokens]))) == n


def test_cache_that_overflows_gives_the_same():
    from muster.llm.pretokens import Bounded, weight

    cache = Bounded({"a": 1}, 2 * weight("b"))
    for token in "abcdefab":
        cache.learn([[token]], lambda new: [len(t) for t in new])
        assert cache[token] == 1 and len(cache) <= 3


def test_texts_longer_than_a_step(documents, monkeypatch):
    from muster.llm import pretokens

    for module in (pretokens, token_counts, byte_bpe):
        monkeypatch.setattr(module, "CHUNK", 50)
    texts = [(1, "some words, and more of them. " * 40), (2, "a" * 300), (3, "x <|endoftext|>" * 30)]
    assert rows(of_tokens(documents(texts))) == pairs(plain.token_counts(texts))
    assert rows(of_ids(documents(texts))) == pairs(plain.byte_bpe(texts))


def test_cache_that_turns_over_between_short_and_long_texts(spark, monkeypatch, tmp_path):
    from muster.llm import pretokens

    for module in (pretokens, byte_bpe):
        monkeypatch.setattr(module, "CHUNK", 50)
    monkeypatch.setattr(byte_bpe, "CACHED", 40 * pretokens.weight("word"))
    # A file of its own name has a cache of its own in the workers.
    own = tmp_path / "ranks.tiktoken"
    own.write_bytes(open(byte_bpe.VOCABULARY, "rb").read())
    long = " ".join(f"xq{j}zv" for j in range(60))
    texts = [(1, "before it"), (2, long), (3, "brief words after"), (4, long[::-1]), (5, "and others")]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = byte_bpe.encode_documents(df, str(own)).select("document.doc_id", "bpe.*")
    assert rows(found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == pairs(plain.byte_bpe(texts))


def _thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


RUN = " ".join(f"x{i}" for i in range(20))
UNIQUE = " ".join(f"only{i}" for i in range(60))


@pytest.mark.parametrize("key", [None, 7])
def test_rows_of_one_key_are_cut_by_their_own_spans(documents, key):
    given = [(key, f"{RUN} mid {RUN}"), (key, UNIQUE), (key, UNIQUE), (9, f"{UNIQUE} end")]
    found = {r.document.text: r.words for r in substring_dedup.remove_repeats(documents(given)).collect()}
    assert found[UNIQUE].n_removed == 0
    assert found[f"{RUN} mid {RUN}"].n_removed == 20
    assert found[f"{UNIQUE} end"].kept == "end"
    assert rows(of_substrings(documents(given))) == pairs(plain.substring_dedup(given))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_are_told_apart(documents, n):
    """Words and texts that polynomials modulo a power of two take for equal."""
    one, two = _thue_morse(n, "a", "b"), _thue_morse(n, "b", "a")
    nineteen = " ".join(f"w{i}" for i in range(19))
    given = [(1, f"{nineteen} {one}"), (2, f"{nineteen} {two}"), (3, one), (4, two), (5, f"{nineteen} {one}")]
    assert rows(of_substrings(documents(given))) == pairs(plain.substring_dedup(given))
    found = {r.doc: r for r in minhash_dedup.near_duplicates(documents(given), words=2).collect()}
    assert [found[i].component for i in range(1, 6)] == [1, 1, 3, 4, 1]


def test_spans_with_overlaps_and_many_sources(documents):
    draw = random.Random(5)
    passages = [" ".join(f"p{k}w{draw.randint(0, 3)}" for _ in range(draw.randint(15, 60))) for k in range(6)]
    given = [
        (i, " ".join(draw.choice(passages) if draw.random() < 0.6 else f"u{i}" for _ in range(6))) for i in range(40)
    ]
    given += [(40, "same word " * 500), (41, "word same " * 700), (41, "word same " * 650)]
    assert rows(of_substrings(documents(given))) == pairs(plain.substring_dedup(given))


def test_near_copies_apart_from_their_centre_link_as_a_forest(spark, documents, monkeypatch):
    """A family whose members are close to each other and none to the smallest document."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", 30)
    base = [f"b{j}" for j in range(100)]
    given = [(0, " ".join(base[:70] + [f"c{j}" for j in range(30)]))]
    for i in range(1, 90):
        w = list(base)
        w[10 + i % 80] = f"own{i}"
        given.append((i, " ".join(w)))
    seen = []
    real = minhash_dedup.components
    monkeypatch.setattr(minhash_dedup, "components", lambda edges, *a: real(seen.append(edges) or edges, *a))
    assert rows(of_groups(2)(documents(given))) == pairs(grouped(2)(given))
    assert seen[-1].count() < 10 * len(given)


@pytest.mark.parametrize("density", [0.02, 0.2])
def test_forest_spans_what_the_links_span(density):
    draw = np.random.default_rng(1)
    near = draw.random((40, 50)) < density
    one, two = minhash_dedup._forest(near)
    assert near[one, two].all() and len(one) < 90

    def groups(edges):
        found = {k: {k} for k in range(90)}
        for a, b in edges:
            both = found[a] | found[40 + b]
            for k in both:
                found[k] = both
        return {frozenset(g) for g in found.values()}

    assert groups(zip(one.tolist(), two.tolist())) == groups(np.argwhere(near).tolist())


def test_cache_is_bounded_by_bytes():
    from muster.llm.pretokens import Bounded, weight

    cache = Bounded({}, 100_000)
    for n in range(50):
        words = [f"{n} {k} " + "long " * 400 for k in range(3)]
        cache.learn([words], lambda new: list(map(len, new)))
        assert all(cache[w] == len(w) for w in words)
        assert sum(map(weight, {**cache, **cache.old})) <= 100_000 + 3 * weight(words[0])
