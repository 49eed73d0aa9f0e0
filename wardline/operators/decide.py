"""Decisions: requests matched with grants, and what follows for statements and audits.

Patterns of a grant are exact names, `*`, or `prefix*`. A grant covers a request if all keys of the
request match and nothing in it is narrower than the request; for the "any" token a grant anywhere
inside the object is enough.
"""

import sys
from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import expressions as X
from wardline.functions.rules import ADMIN_TOKEN, ANY_TOKEN
from wardline.operators.history import BLOCK, standing, words_between
from wardline.operators.requests import fan_out_columns
from wardline.operators.sizing import BROADCAST_BYTES, row_bytes

# How many patterns may be tried one after the other for one request in the broadcast plan.
MAX_TRIES = 256

_WHO = ["user_name", "token", "level"]
# A question has names of its own: inside a subquery a name that both sides know is the inner one.
_ASKING = ["q_user_name", "q_token", "q_level"]
_QUESTION = [*_ASKING, "q1", "q2", "q3"]
# Grants with a history hold from one version of the policies to another, or in some versions of a block (`held`); a
# request is asked at one version.
_VALID, _AT = ["since", "until"], "q_version"
_FOREVER = 2**62


def _question_of(df: DataFrame) -> list[str]:
    return [*_QUESTION, _AT] if _AT in df.columns else _QUESTION


# A pattern as the text to compare with, and the length of the prefix that counts (-1: the whole name).
_TEXT = "IF(endswith({0}, '*'), left({0}, length({0}) - 1), {0}) AS {1}_text"
_LENGTH = "IF(endswith({0}, '*'), length({0}) - 1, -1) AS {1}_length"

# The facts a grant stands for: level, token, condition, and what its three keys are.
_FACTS = """
C  own  on_tables                                          db  tbl  col
T  own  on_tables AND col_length = 0                       db  tbl  -
D  own  on_tables AND col_length = 0 AND tbl_length = 0    db  -    -
F  own  NOT on_tables                                      db  udf  -
C  any  on_tables                                          db  tbl  col
T  any  on_tables                                          db  tbl  -
F  any  NOT on_tables                                      db  udf  -
D  any  true                                               db  -    -
D  any  true                                               all -    -
"""


def _fact(line: str) -> str:
    level, token, *condition, first, second, third = line.split()
    keys = []
    for number, key in enumerate((first, second, third), 1):
        fixed = {"-": "''", "all": "'*'"}.get(key)
        text, length = (fixed, "-1") if fixed else (f"{key}_text", f"{key}_length")
        keys.append(f"'k{number}', {text}, 'n{number}', {length}")
    token = "token" if token == "own" else f"'{ANY_TOKEN}'"
    return f"IF({' '.join(condition)}, named_struct('token', {token}, 'level', '{level}', {', '.join(keys)}), NULL)"


def compile_grants(grants: DataFrame) -> DataFrame:
    """Grants as facts, one per token and level (D, T, C, F) of the requests they can answer.

    A fact has three keys (database; table or function; column), each a text `k` with a prefix
    length `n`. Unused keys are the exact empty text. Grants with a history (`since`, `until`, and `held`
    if it has gaps) give facts that hold as long.
    """
    udf = "udf" if "udf" in grants.columns else "CAST(NULL AS STRING)"
    patterns = {"db": "coalesce(db, '*')", "tbl": "coalesce(tbl, '*')", "col": "coalesce(col, '*')", "udf": udf}
    held = "held" if "held" in grants.columns else "CAST(NULL AS ARRAY<BIGINT>) AS held"
    valid = ["coalesce(since, 0L) AS since", f"coalesce(until, {_FOREVER}L) AS until", held] if "since" in grants.columns else []
    known = grants.where("user_name IS NOT NULL AND access IS NOT NULL").selectExpr(
        "user_name",
        *valid,
        f"IF(lower(access) = 'admin', '{ADMIN_TOKEN}', lower(access)) AS token",
        f"{udf} IS NULL AS on_tables",
        *[form.format(sql, name) for name, sql in patterns.items() for form in (_TEXT, _LENGTH)],
    )
    facts = ", ".join(map(_fact, _FACTS.strip().splitlines()))
    return known.selectExpr("user_name", *([*_VALID, "held"] if valid else []), f"inline(array_compact(array({facts})))")


def with_question(reqs: DataFrame) -> DataFrame:
    """Adds the question a request puts to the grants: who, with which token, on which level and names, and at which version, if it has one."""
    column = "column_name" if "column_name" in reqs.columns else "column"
    return reqs.select(
        "*",
        *([F.col("version").alias(_AT)] if "version" in reqs.columns else []),
        F.expr("user_name AS q_user_name"),
        X.access_token().alias("q_token"),
        F.expr("""
            CASE object_type WHEN 'DATABASE' THEN 'D' WHEN 'TABLE' THEN 'T' WHEN 'VIEW' THEN 'T'
                             WHEN 'COLUMN' THEN 'C' WHEN 'FUNCTION' THEN 'F' END AS q_level"""),
        F.expr("database AS q1"),
        F.expr("coalesce(table, udf, '') AS q2"),
        F.expr(f"IF(object_type = 'COLUMN', coalesce({column}, ''), '') AS q3"),
    )


class GrantSize(NamedTuple):
    bytes: int
    tries: int


def measure_grants(grants: DataFrame) -> GrantSize:
    """Upper bounds from one aggregate: the bytes of all facts, and how many patterns a request may have to try.

    Patterns for a database or a table are tried by user, those for a column by user and table.
    """
    by_table = "endswith(coalesce(db, '*'), '*') OR endswith(IF(udf IS NULL, coalesce(tbl, '*'), udf), '*')"
    open_end = f"({by_table} OR (udf IS NULL AND endswith(coalesce(col, '*'), '*')))"
    grants = grants if "udf" in grants.columns else grants.withColumn("udf", F.lit(None).cast("string"))
    lists = grants.select(
        "user_name",
        F.expr(f"IF({by_table}, NULL, struct(db, tbl)) AS place"),
        F.expr(f"CAST({open_end} AS BIGINT) AS tried"),
        row_bytes(grants).alias("bytes"),
    )
    each = lists.groupBy("user_name", "place").agg(F.expr("sum(tried) AS tries"), F.expr("sum(bytes) AS bytes"))
    total = each.selectExpr("sum(bytes) AS bytes", "max(tries) AS tries").first()
    return GrantSize(len(_FACTS.strip().splitlines()) * (total["bytes"] or 0), (total["tries"] or 0) + 1)


def broadcastable(grants: DataFrame, limit: int = BROADCAST_BYTES, tries: int = MAX_TRIES) -> bool:
    """Whether the grants are proven small enough to sit in every executor and be tried in turn."""
    size = measure_grants(grants)
    return size.bytes <= limit and size.tries <= tries


def triable(grants: DataFrame, **sizes) -> bool:
    """Whether a stream can try the grants: they may be of any size, but each user has few patterns."""
    return broadcastable(grants, **{**sizes, "limit": sys.maxsize})


def _held(number: int) -> Column:
    """Whether a name of the outer question matches the key of a fact."""
    wanted, text, length = F.col(f"q{number}").outer(), F.col(f"k{number}"), F.col(f"n{number}")
    return F.when(length < 0, wanted == text).otherwise(wanted.startswith(text))


def answer_by_broadcast(questions: DataFrame, facts: DataFrame, hint: bool = True) -> DataFrame:
    """Adds `allowed` by hash lookups in broadcast facts; the questions are not moved.

    Without the hint the same lookups are joins on equal keys that Spark may shuffle, for streams with
    facts of any size of which each user has few patterns to try.

    Facts on exact names are found by name, facts on an exact table by table, and only those with a
    pattern for database or table are tried in turn.
    """
    who = [F.col(q).outer() == F.col(c) for q, c in zip(_ASKING, _WHO)]
    same = {i: F.col(f"q{i}").outer() == F.col(f"k{i}") for i in (1, 2, 3)}
    fixed_table, fixed_column = (F.col("n1") == -1) & (F.col("n2") == -1), F.col("n3") == -1
    if "since" in facts.columns:
        at = F.col(_AT).outer()
        who += [F.col("since") <= at, at < F.col("until"), F.col("held").isNull() | standing(F.col("held"), at)]

    def some(part, *conditions):
        found = F.broadcast(part) if hint else part
        for condition in [*who, *conditions]:
            found = found.where(condition)
        return found.exists()

    by_name = some(facts.where(fixed_table & fixed_column), same[1], same[2], same[3])
    by_table = some(facts.where(fixed_table & ~fixed_column), same[1], same[2], _held(3))
    by_pattern = some(facts.where(~fixed_table), _held(1), _held(2), _held(3))
    answered = questions.select("*", by_name.alias("a1"), by_table.alias("a2"), by_pattern.alias("a3"))
    return answered.withColumn("allowed", F.col("a1") | F.col("a2") | F.col("a3")).drop("a1", "a2", "a3")


def answer_by_shuffle(questions: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds `allowed` for grants of any size, by a walk down the trie of the facts.

    The nodes of the trie are what facts say of a database, then of a table or function, then of a
    column. Requests collapse to distinct questions first. A question comes to the roots of its user,
    token and level; at each node it reaches it is cut to the lengths of prefixes that this node's
    children have, and looked up among them by equal keys. So it meets only children of nodes that
    hold it, however many patterns its user has elsewhere. The answers then go back to the requests.
    Hot users and questions are left to AQE, which splits what is measured to be large.
    """
    known = facts.distinct().withColumnsRenamed(dict(zip(_WHO, _ASKING)))
    reached, path = questions.select(*_QUESTION).where("q_level IS NOT NULL").distinct(), list(_ASKING)
    for i in (1, 2, 3):
        value, n = F.col(f"q{i}"), F.col(f"n{i}")
        # The lengths at a node are bounded by the longest name, whatever the number of its children.
        nodes = known.groupBy(*path).agg(F.collect_set(f"n{i}").alias("lengths"))
        cut = F.when(n < 0, value).when(F.length(value) >= n, F.left(value, n))
        reached = reached.join(nodes, path).withColumn(f"n{i}", F.explode("lengths")).drop("lengths").withColumn(f"k{i}", cut).where(f"k{i} IS NOT NULL")
        path += [f"k{i}", f"n{i}"]
    if "since" in facts.columns:
        return _answer_at_versions(questions, reached, known, path)
    a, b = reached.alias("a"), known.alias("b")
    held = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in path], "left_semi").select(*_QUESTION).distinct()
    answered = questions.join(held.withColumn("allowed", F.lit(True)), _QUESTION, "left")
    return answered.withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def _answer_at_versions(questions: DataFrame, reached: DataFrame, known: DataFrame, path: list[str]) -> DataFrame:
    """Adds `allowed` at the version of each question, from the leaves that questions reach.

    A question is answered once for each block of versions it is asked at: the bits of all facts that
    answer it make up words, and only these go back to the requests.
    """
    block = F.expr(f"{_AT} DIV {BLOCK}").alias("block")
    blocks = questions.where("q_level IS NOT NULL").select(*_QUESTION, block).where("block IS NOT NULL").distinct()
    a, b = reached.join(blocks, _QUESTION).alias("a"), known.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in path]
    same += [F.col("b.since") < (F.col("a.block") + 1) * BLOCK, F.col("b.until") > F.col("a.block") * BLOCK]
    whole = words_between(F.col("b.since"), F.col("b.until"), F.col("a.block"))
    words = [F.when(F.col("b.held").isNull(), w).otherwise(F.get("b.held", F.lit(k))).alias(f"__{k}") for k, w in enumerate(whole)]
    met = a.join(b, same).select(*[F.col(f"a.{c}") for c in [*_QUESTION, "block"]], *words)
    said = met.groupBy(*_QUESTION, "block").agg(*[F.bit_or(f"__{k}").alias(f"__{k}") for k in range(len(words))])
    said = said.select(*_QUESTION, "block", F.array(*[f"__{k}" for k in range(len(words))]).alias("__held"))
    answered = questions.withColumn("__block", block).join(said.withColumnRenamed("block", "__block"), [*_QUESTION, "__block"], "left")
    return answered.withColumn("allowed", F.coalesce(standing(F.col("__held"), F.col(_AT)), F.lit(False))).drop("__block", "__held")


def match_grants(reqs: DataFrame, grants: DataFrame, **sizes) -> DataFrame:
    """`reqs` with `allowed`, null where the request has no level to be asked on (a check without a result).

    The grants are measured first; both ways give the same answers. A stream cannot walk down the
    trie, as it may not bring its rows together again: with more patterns to try than the bound it is
    refused, and `audit_stream` with `load_grants` judges its batches. With a history of grants the requests carry the `version` they are judged at.
    """
    if ("since" in grants.columns) != ("version" in reqs.columns):
        raise ValueError("grants with a history need requests with a version, and the other way round")
    if not reqs.isStreaming:
        answer = answer_by_broadcast if broadcastable(grants, **sizes) else answer_by_shuffle
    elif triable(grants, **sizes):
        answer = partial(answer_by_broadcast, hint=broadcastable(grants, **sizes))
    else:
        raise ValueError("these grants have too many patterns to be tried by a stream: give them to audit_stream, which judges by batches")
    questions = with_question(reqs)
    # How often a grant stands in the set does not count; the walk sorts and groups the facts of each.
    answered = answer(questions, compile_grants(grants.distinct() if answer is answer_by_shuffle else grants))
    return answered.withColumn("allowed", F.when(F.col("q_level").isNotNull(), F.col("allowed"))).drop(*_question_of(questions))


def on_null(allowed="allowed", verdict: bool = True) -> Column:
    """A check without a result lets pass."""
    return F.coalesce(F.col(allowed), F.lit(verdict))


def decide(reqs: DataFrame, grants: DataFrame, null_allows: bool = True, **sizes) -> DataFrame:
    """Requests, one per column, with `allowed`. A relation that cannot be checked is not.

    `null_allows` says what a check without a result means: a request on a kind of object that no
    grant can speak of.
    """
    matched = match_grants(fan_out_columns(reqs), grants, **sizes)
    return matched.withColumn("allowed", F.col("reason").isNull() & on_null(verdict=null_allows))


def denials(decisions: DataFrame) -> DataFrame:
    """The denied requests, with the `message` of each."""
    denied = decisions.where(~F.col("allowed")).drop("allowed")
    return denied.withColumn("message", F.coalesce("reason", X.denial_message()))


def first_denials(decisions: DataFrame) -> DataFrame:
    """The first denial of each statement that has one; only denials are grouped."""
    first = denials(decisions).groupBy("stmt_id").agg(F.expr("min(struct(seq, message)) AS first"))
    return first.selectExpr("stmt_id", "first.seq AS denied_seq", "first.message AS message")


def statement_verdict(classified: DataFrame, decisions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per statement: allowed unless some request of it is denied."""
    verdicts = classified.select("stmt_id", "user_name", "op", *keep).join(first_denials(decisions), "stmt_id", "left")
    return verdicts.withColumn("allowed", F.col("denied_seq").isNull()).drop("denied_seq")


#: Which decisions of a statement are recorded, by its first denied position.
RECORDED = "denied_seq IS NULL OR (seq <= denied_seq AND denied_seq >= 0)"


def audit_rows(decisions: DataFrame) -> DataFrame:
    """Decisions that are recorded: up to the first denied request, all of its columns included.

    Relations that cannot be checked end a statement before any decision is made: their position is
    below zero. The first denial comes from an aggregate of denials and a join, so that no task has
    to hold a whole statement. No other filter is put on the decisions: both sides of the join then
    read the same exchanges of the log, which Spark makes once.
    """
    denied = decisions.where(~F.col("allowed")).groupBy("stmt_id").agg(F.expr("min(seq) AS denied_seq"))
    return decisions.join(denied, "stmt_id", "left").where(RECORDED).drop("denied_seq", "reason")
