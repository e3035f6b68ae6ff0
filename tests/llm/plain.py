"""Brute-force versions of the corpus operators, on lists of (doc_id, text)."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring_dedup(rows, window=20):
    """(doc_id, n_words, n_removed, sha of the kept words) of each row.

    A document is a key and a text; those of one key come in the order of a digest of the text.
    """
    words = [(i, t or "", WORD.findall(t or "")) for i, t in rows]

    def document(i, t):
        digest = xxhash.xxh64_intdigest(t.encode(), 42)
        return (i is not None, i or 0, digest - (1 << 64) if digest >> 63 else digest)

    least = {}
    for i, t, w in words:
        for s in range(len(w) - window + 1):
            k, here = tuple(w[s : s + window]), (document(i, t), s)
            least[k] = min(least.get(k, here), here)
    out = []
    for i, t, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if least[tuple(w[s : s + window])] != (document(i, t), s):
                gone.update(range(s, s + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), sha(" ".join(kept))))
    return out


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[j:] for j in range(k))))


def near_duplicates(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(sets[i]), find(i), find(i) == i) for i, _ in rows]


def line_dedup(rows, min_chars=20, min_documents=3):
    """(doc_id, n_lines, n_dropped, kept text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        me = -1 if i is None else i
        kept = [
            x for x in lines
            if len(holders.get(key(x), ())) < min_documents or (max(holders[key(x)]) == me and me != -1)
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def token_counts(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = [len(e.ids) for e in t.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    return [(i, len((t or "").encode()), c, c > 1024) for (i, t), c in zip(rows, n, strict=True)]


def byte_bpe(rows):
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the rules' votes."""
    text = text or ""
    w = WORD.findall(text)
    n, chars = len(w), sum(map(len, w))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    duplicates = len(lines) - len(set(lines))
    places = defaultdict(list)
    for i in range(n - 7):
        places[tuple(w[i : i + 8])].append(i)
    repeated = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    letters, distinct, again = sum(c.isalpha() for c in text), len(set(w)), len(repeated)
    vote = lambda good, bad: 1 if good else -1 if bad else 0
    votes = (
        vote(n >= 50, n < 20),
        vote(4 * n <= chars <= 7 * n, chars < 3 * n or chars > 10 * n),
        vote(100 * symbols <= chars, 100 * symbols > 4 * chars),
        vote(100 * letters >= 90 * chars, 100 * letters < 80 * chars),
        vote(10 * duplicates <= len(lines), 10 * duplicates > 3 * len(lines)),
        vote(20 * again <= n, 4 * again > n),
        vote(n <= 2000 and 100 * distinct >= 45 * n, 100 <= n <= 2000 and 100 * distinct < 25 * n),
    )
    return (n, chars, symbols, duplicates, again, n < 20 or 100 * again > 30 * n), votes


def quality(rows, iterations=30):
    """(doc_id, *statistics, kept)."""
    judged = [(i, *statistics(t)) for i, t in rows]
    counts = Counter(v for _, s, v in judged if not s[-1])
    prior, right, caught = 0.85, [0.95] * 7, [0.5] * 7

    def posterior(votes):
        z = math.log(1 - prior) - math.log(prior)
        for v, s, t in zip(votes, right, caught, strict=True):
            z += (math.log(1 - t) - math.log(s)) if v == 1 else (math.log(t) - math.log(1 - s)) if v == -1 else 0
        return 1 / (1 + math.exp(z))

    for _ in range(iterations):
        weighed = [(v, n, posterior(v)) for v, n in sorted(counts.items())]
        total = sum(n for _, n, _ in weighed)
        new_prior = min(0.95, max(0.05, (sum(n * g for _, n, g in weighed) + 0.5) / (total + 1)))
        new_right, new_caught = [], []
        for j in range(7):
            s = (sum(n * g for v, n, g in weighed if v[j] == 1) + 0.5) / (sum(n * g for v, n, g in weighed if v[j]) + 1)
            t = (sum(n * (1 - g) for v, n, g in weighed if v[j] == -1) + 0.5) / (
                sum(n * (1 - g) for v, n, g in weighed if v[j]) + 1
            )
            s = max(0.6, s)
            new_right.append(s)
            new_caught.append(max(t, min(0.99, 2 * (1 - s))))
        prior, right, caught = new_prior, new_right, new_caught
    return [(i, *s, not s[-1] and posterior(v) >= 0.5) for i, s, v in judged]


def plain_words(text):
    return " ".join(re.findall(r"\w+", (text or "").lower()))


def edit_distance(segment, text):
    """Least edits between the segment and any substring of the text."""
    cost, least = list(range(len(segment) + 1)), len(segment)
    for c in text:
        new = [0]
        for i, s in enumerate(segment):
            new.append(min(cost[i] + (s != c), cost[i + 1] + 1, new[i] + 1))
        cost, least = new, min(least, new[-1])
    return least


def segments(text):
    """(start, length, edits) of the segments of a normalised item."""
    n = len(text)
    if n < 24:
        return []
    size = min(64, n)
    starts = sorted({*range(0, n - size + 1, 12), n - size})
    return [(s, size, max(0, min(size * 8 // 100, (size - 10) // 10))) for s in starts]


def contaminated(rows, items):
    """{(doc_id, item_id): segments found}."""
    out = {}
    for i, t in rows:
        for k, item in items:
            item = plain_words(item)
            found = sum(
                edit_distance(item[s : s + n], plain_words(t)) <= e for s, n, e in segments(item)
            )
            if found:
                out[i, k] = found
    return out


def periodic_runs(words, min_words=24, exponent=3):
    """(start, length, period) of all maximal runs with their smallest period."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(min_words, exponent * q):
                    # A run of a multiple of its period has the same place and length.
                    found.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def op11(rows):
    """doc_id -> the columns of the query."""
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
        runs = periodic_runs(w)
        gone = {x for s, length, q in runs for x in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        out.append(
            (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
             sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
             sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
        )
    return out
