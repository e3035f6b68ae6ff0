"""Allow and block entries for URLs: a broadcast trie, the longest match wins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.tables import table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"
# A trie of more entries is not broadcast; rules are then matched by joins.
MAX_BROADCAST_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Node = tuple[dict, list]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def split_rule(rule: str) -> tuple[list[str], list[str], str]:
    """Reversed host labels, whole path segments, and the start that the next segment must have."""
    host, slash, path = rule.partition("/")
    *segments, start = (slash + path).split("/")
    return host.translate(str.maketrans(UPPER, LOWER)).split(".")[::-1], segments, start


def build_trie(rules: list[tuple[str, str]]) -> Node:
    """Nested (children, entries); below the host labels hang the path segments, under a None edge.

    An entry is (start of the next segment, rule, verdict). Of rules with one host and path, whatever the
    case of their hosts, a block wins, then the rule that is last in order.
    """
    root: Node = ({}, [])
    best: dict[tuple[str, str], tuple[str, str]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        same = host.translate(str.maketrans(UPPER, LOWER)), slash + path
        best[same] = max((verdict, rule), best.get(same, ("", "")))
    for verdict, rule in sorted(best.values()):
        labels, segments, start = split_rule(rule)
        node = root
        for edge in (*labels, None, *segments):
            node = node[0].setdefault(edge, ({}, []))
        node[1].append((start, rule, verdict))
    return root


def match(trie: Node, host: str, path: str) -> tuple[str | None, str | None]:
    """The rule with the most host labels, then the longest path, that fits; or (None, None)."""
    pieces, found, node = path.split("/"), (None, None), trie
    for label in host.split(".")[::-1]:
        node = node[0].get(label)
        if node is None:
            break
        below = node[0].get(None)
        best = -1
        for depth, piece in enumerate((*pieces, "")):
            if below is None:
                break
            if depth < len(pieces):
                for start, rule, verdict in below[1]:
                    length = depth * 65536 + len(start)
                    if piece.startswith(start) and length > best:
                        best, found = length, (rule, verdict)
            below = below[0].get(piece)
    return found


def _judged(urls: DataFrame, url: str) -> DataFrame:
    given = urls.select(F.struct("*").alias("page"), F.col(url).alias("_url"))
    return given.select("page", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))


def _by_trie(rows: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    trie = rows.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in parts:
            pairs = [match(root, h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(pairs, columns=["rule", "verdict"], dtype=object)

    return rows.withColumn("match", look_up("host", "path"))


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by equi-joins: each URL asks for the rules under its distinct host suffixes.

    Rules that share a host are spread over their whole path segments, which are part of the key.
    Only distinct (host, path) pairs are joined, so that repeated URLs don't multiply.
    """
    entries = rules.select(
        "verdict",
        "rule",
        F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("suffix"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("prefix"),
    ).groupBy("suffix", "prefix").agg(F.max(F.struct("verdict", "rule")).alias("best"))
    entries = entries.select("suffix", "prefix", "best.rule", "best.verdict")
    keyed = entries.withColumn(
        "folder", F.expr("substring(prefix, 1, length(prefix) - length(substring_index(prefix, '/', -1)))")
    )
    asked = rows.select("host", "path").distinct()
    labels, pieces = F.split("host", r"\."), F.split("path", "/")
    suffixes = asked.select(
        "*",
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"),
    )
    folders = suffixes.select(
        "*",
        F.explode(F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: F.array_join(F.concat(F.slice(pieces, 1, i), F.array(F.lit(""))), "/"))).alias("folder"),
    )
    best = (
        folders.join(keyed, ["suffix", "folder"])
        .filter(F.col("path").startswith(F.col("prefix")))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct("rule", "verdict"), F.struct(F.length("suffix"), F.length("prefix"))
            ).alias("match")
        )
    )
    return rows.join(best, ["host", "path"], "left")


def filter_urls(
    urls: DataFrame,
    rules: list[tuple[str, str]] | DataFrame = RULES,
    default: str = DEFAULT,
    url: str = "url",
    max_broadcast: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """``page`` (the row as a struct), ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    A rule is ``host/path``. It fits its host and all subdomains if the path of the URL starts with
    its path; the most host labels win, then the longest path; an allow entry below a block entry so
    lifts it and the reverse. Of two entries for one rule the block wins. Without a match the rule is
    null and the verdict is ``default``.

    The entries are a trie over reversed host labels and path segments, broadcast up to
    ``max_broadcast`` entries; a larger table of rules is matched by equi-joins instead.

    Null URL or one without ``://``: host and path empty, default verdict. Repeated rows: each is
    judged. Very long URLs are judged whole. Empty table: no rows. Extra columns stay inside ``page``,
    whatever their names.
    """
    rows = _judged(urls, url)
    if isinstance(rules, DataFrame):
        listed = rules.select("verdict", "rule").limit(max_broadcast + 1).collect()
        large = len(listed) > max_broadcast
        matched = _by_join(rows, rules) if large else _by_trie(rows, [tuple(r) for r in listed])
    elif len(rules) > max_broadcast:
        frame = urls.sparkSession.createDataFrame(list(rules), "verdict string, rule string")
        matched = _by_join(rows, frame)
    else:
        matched = _by_trie(rows, list(rules))
    return matched.select(
        "page",
        "host",
        "path",
        F.col("match.rule").alias("rule"),
        F.coalesce("match.verdict", F.lit(default)).alias("verdict"),
    )


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages).select("page.page_id", "host", "path", "rule", "verdict")


def sql() -> str:
    rules = ", ".join(
        f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')"
        for verdict, rule in RULES
    )
    return f"""
with judged as (
  select page_id,
    case when url like '%://%' then translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
      '{UPPER}', '{LOWER}') else '' end as host,
    case when url like '%://%' then regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) else '' end as path
  from pages
), rules (verdict, rule, suffix, prefix) as (values {rules}
), fits as (
  select page_id, rule, verdict,
    row_number() over (partition by page_id order by length(suffix) desc, length(prefix) desc) as place
  from judged, rules
  where (host = suffix or host like '%.' || suffix) and starts_with(path, prefix)
)
select j.page_id, j.host, j.path, f.rule, coalesce(f.verdict, '{DEFAULT}') as verdict
from judged j left join fits f on f.page_id = j.page_id and f.place = 1"""
