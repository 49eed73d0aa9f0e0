"""URL filters: glob rules as one bit-parallel wildcard automaton.

Every rule is a row of states in one long bit vector of several 64-bit words. A character of the
url moves all states of all rules at once: shift, mask by the character, keep the states that a
wildcard holds. The urls of a block advance together, so that one step is a few vector operations.
"""

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import read, struct_udf

_ONE, _SIXTY_THREE = np.uint64(1), np.uint64(63)


class Rule(NamedTuple):
    """`glob`: `*` is any run without `/` and `?`, `**` any run, all else itself; over the whole canonical url."""

    glob: str
    verdict: str
    name: str | None = None


def host_rule(verdict: str, rule: str) -> Rule:
    """A rule `host/path`: the host and its subdomains, for paths that start with `/path`."""
    return Rule(f"*.{rule}**", verdict, rule)


#: Rules of hosts and paths; the longest that fits decides.
HOST_RULES = (
    host_rule("block", "net/"), host_rule("allow", "example.net/en/"), host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"),
)
#: Where none of those fits, one of these blocks; all else is allowed.
GLOB_RULES = tuple(Rule(glob, "block") for glob in ("*.spam-*.**", "*.ads.**", "**/wp-login*", "**?*sessionid=**", "**.exe"))


class Automaton:
    """The packed masks of all rules. `step[c]`: states that a byte enters; `stay[c]`: states that it does not leave."""

    def __init__(self, globs: Sequence[str]):
        self.first, self.last, states = [], [], 0
        enters: list[tuple[int, int]] = []
        holds: list[tuple[int, bool]] = []
        for glob in globs:
            self.first.append(states)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i : i + 1] == b"*":
                    far = raw[i : i + 2] == b"**"
                    holds.append((states, far))
                    i += 1 + far
                else:
                    states += 1
                    enters.append((states, raw[i]))
                    i += 1
            self.last.append(states)
            states += 1
        self.words = max(1, -(-states // 64))
        self.step, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        for state, byte in enters:
            self._set(self.step[byte], state)
        for state, far in holds:
            for byte in range(256):
                if far or byte not in b"/?":
                    self._set(self.stay[byte], state)
        self.start = np.zeros(self.words, np.uint64)
        for state in self.first:
            self._set(self.start, state)

    @staticmethod
    def _set(mask: np.ndarray, state: int) -> None:
        mask[state // 64] |= _ONE << np.uint64(state % 64)

    def match(self, urls: Sequence[str]) -> np.ndarray:
        """Whether each rule (column) fits each whole url (row)."""
        raw = [u.encode("utf-8", "surrogatepass") for u in urls]
        order = np.argsort([-len(r) for r in raw], kind="stable")
        ends = np.array([len(raw[i]) for i in order], dtype=np.int64)
        flat, begins = np.frombuffer(b"".join(raw[i] for i in order), np.uint8), np.concatenate(([0], np.cumsum(ends)[:-1])) if len(raw) else ends
        state = np.tile(self.start, (len(raw), 1))
        for at in range(int(ends[0]) if len(raw) else 0):
            n = int(np.searchsorted(-ends, -at))  # the longest come first
            byte, now = flat[begins[:n] + at], state[:n]
            moved = now << _ONE
            moved[:, 1:] |= now[:, :-1] >> _SIXTY_THREE
            state[:n] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.zeros((len(raw), len(self.last)), bool)
        for k, last in enumerate(self.last):
            out[order, k] = (state[:, last // 64] >> np.uint64(last % 64)) & _ONE != 0
        return out


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null or without `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """A dot, the host, the path, and the query with its `?`; empty where there is no host."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(F.coalesce(url, F.lit("")).contains("://"), F.concat(F.lit("."), url_host(url), url_path(url), query)).otherwise("")


def judge_urls(
    df: DataFrame, url: str = "url", host_rules: Sequence[Rule] = HOST_RULES, glob_rules: Sequence[Rule] = GLOB_RULES, default: str = "allow"
) -> DataFrame:
    """`df` with host, path, rule, glob and verdict of each url.

    The longest host rule decides; without one the first glob rule that fits, whose text is in
    `glob`; else the default. A null url or one without `://` has an empty host and path and
    gets the default. Rows are neither dropped nor merged; columns of `df` with one of the five
    names are replaced.
    """
    rules = [*host_rules, *glob_rules]
    rank = sorted(range(len(host_rules)), key=lambda k: (-len(rules[k].name or ""), k)) + list(range(len(host_rules), len(rules)))

    def start():
        automaton = Automaton([rules[k].glob for k in rank])

        def step(urls):
            fits = automaton.match([u or "" for u in urls])
            first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1) if rank else np.full(len(urls), -1)
            hit = [rules[rank[k]] if k >= 0 and u else None for k, u in zip(first, urls, strict=True)]
            return (
                [r and r.name for r in hit], [r.glob if r and r.name is None else None for r in hit], [r.verdict if r else default for r in hit],
            )

        return step

    judged = struct_udf("rule string, glob string, verdict string", start)
    u = F.col(url)
    out = df.select("*", judged(canonical(u)).alias("__judged"), url_host(u).alias("__host"), url_path(u).alias("__path"))
    kept = [F.col(c) for c in df.columns if c not in ("host", "path", "rule", "glob", "verdict")]
    return out.select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"), "__judged.rule", "__judged.glob", "__judged.verdict")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "glob")


_HOST = r"translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH parts AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^?#]*(\?[^#]*)', 1) AS query, coalesce(contains(url, '://'), false) AS named
  FROM pages),
rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
placed AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM rules),
judged AS (
  SELECT parts.*, (SELECT max_by(rule, length(rule)) FROM placed
                   WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule
  FROM parts),
globs AS (
  SELECT *, CASE WHEN NOT named OR rule IS NOT NULL THEN NULL
    WHEN regexp_full_match('.' || host || path || query, '[^/?]*\.spam-[^/?]*\.(?s:.*)') THEN '*.spam-*.**'
    WHEN regexp_full_match('.' || host || path || query, '[^/?]*\.ads\.(?s:.*)') THEN '*.ads.**'
    WHEN regexp_full_match('.' || host || path || query, '(?s:.*)/wp-login[^/?]*') THEN '**/wp-login*'
    WHEN regexp_full_match('.' || host || path || query, '(?s:.*)\?[^/?]*sessionid=(?s:.*)') THEN '**?*sessionid=**'
    WHEN regexp_full_match('.' || host || path || query, '(?s:.*)\.exe') THEN '**.exe' END AS pattern
  FROM judged)
SELECT page_id, host, path, globs.rule, coalesce(placed.verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern AS "glob"
FROM globs LEFT JOIN placed ON placed.rule = globs.rule
"""
