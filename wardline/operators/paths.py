"""Access to file paths, checked against a listing of existing files.

Every file is summed up in each of its ancestor folders, so a path is answered by one equal-key
lookup, however many files lie below it. A folder's summary has a fixed size: whether all files
below permit an action to everybody, and else the one owner of all files that do not.

Globs are `*`, `?`, `[ab]`, `[!a]`, `{a,b/c}` (also nested) and `\\x` for a sign x as itself. Braces are
written out first; what is left of a path is translated sign by sign. A path that is no valid glob
fails alone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import expressions as X
from wardline.functions.rules import FILE_SCHEMES
from wardline.operators.sizing import fits
from wardline.session import written

# Signs that globs use. Where they are escaped they stand as letters of a private area meanwhile.
_SIGNS = "\\*?[]{},!^-"
_HIDDEN = "".join(chr(0xE000 + k) for k in range(len(_SIGNS)))


def _strip(path: Column) -> Column:
    return F.when(path.rlike(r"[^/]/+$"), F.regexp_replace(path, r"/+$", "")).otherwise(path)


def _ancestors(path: Column, include_self: bool) -> Column:
    """Paths of the folders above a path, from the top; the path itself last, if wanted."""
    parts = F.split(path, "/")
    last = F.size(parts) if include_self else F.size(parts) - 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def _guarded_by(action: str) -> Column:
    """Owner of a file that everybody else is refused an action on."""
    others = F.coalesce("others_action", F.lit("NONE"))
    open_to_all = (others == "ALL") | ((others == "READ") if action == "READ" else F.lit(False))
    return F.when(~open_to_all, F.coalesce("owner", F.lit("")))


_SUMMARY = ["read_lo", "read_hi", "all_lo", "all_hi"]


def _summarize(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("read_lo").alias("read_lo"), F.max("read_hi").alias("read_hi"),
        F.min("all_lo").alias("all_lo"), F.max("all_hi").alias("all_hi"), *more,
    )


def _below(file_status: DataFrame) -> DataFrame:
    """Each file at itself and at each folder above it (`node`), with who guards it."""
    read, full = _guarded_by("READ"), _guarded_by("ALL")
    files = file_status.select(
        _strip(F.col("path")).alias("file"),
        read.alias("read_lo"), read.alias("read_hi"), full.alias("all_lo"), full.alias("all_hi"),
    )
    return files.select("*", F.explode(_ancestors(F.col("file"), True)).alias("node"))


def folder_summaries(file_status: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """One row per file and folder: `node`, and the least and greatest owner who guards a file below.

    A node that is listed itself also has its `own` summary. `only` keeps the nodes it names: before
    the files are grouped if it fits a broadcast, else afterwards, when every node is one row.
    """
    below = _below(file_status)
    early = only is not None and fits(only)
    if early:
        below = below.join(F.broadcast(only), "node", "left_semi")
    own = F.max(F.when(F.col("node") == F.col("file"), F.struct(*_SUMMARY))).alias("own")
    nodes = _summarize(below, ["node"], own)
    return nodes if only is None or early else nodes.join(only, "node", "left_semi")


def _hidden(path: Column) -> Column:
    """`path` with escaped signs as private letters; null if an escape has no sign behind it."""
    text = path
    for sign, letter in zip(_SIGNS, _HIDDEN):
        text = F.replace(text, F.lit("\\" + sign), F.lit(letter))
    text = F.regexp_replace(text, r"\\(.)", "$1")
    return F.when(~text.contains("\\"), text)


def _shown(text: Column) -> Column:
    return F.translate(text, _HIDDEN, _SIGNS)


_GROUP = r"(?s)\A(.*?)\{([^{}]*)\}(.*)\z"


def _names(path: Column) -> Column:
    """A path without braces for each combination of their parts, still with hidden signs; none if it is no valid glob."""
    text = _hidden(path)

    def opened(done, _):
        def one(name):
            alternatives = F.split(F.regexp_extract(name, _GROUP, 2), ",", -1)
            written = F.transform(alternatives, lambda part: F.concat(F.regexp_extract(name, _GROUP, 1), part, F.regexp_extract(name, _GROUP, 3)))
            return F.when(name.rlike(_GROUP), written).otherwise(F.array(name))

        return F.flatten(F.transform(done, one))

    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    written = F.when(braces > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(braces, F.lit(1))), F.array(text), opened)).otherwise(F.array(text))
    is_valid = lambda name: ~name.contains("{") & name.rlike(r"(?s)\A(?:[^\[]|\[[^\[\]/]+\])*\z")
    valid = F.when(text.isNotNull() & F.forall(written, is_valid), F.array_distinct(written))
    # Most paths are no globs and escape nothing.
    return F.when(path.rlike(r"[\\\[\]{}*?]"), valid).otherwise(F.array(path))


_SPECIAL = r"[*?\[]"


def _glob_regex(name: Column) -> Column:
    """A path with `*`, `?` and sets as a regular expression over whole paths, sign by sign."""

    def one(sign):
        inner = F.regexp_replace(_shown(F.regexp_replace(sign, r"(?s)\A\[[!^]?(.*)\]\z", "$1")), r"([\\\[\]&^])", r"\\$1")
        negated = sign.rlike(r"\A\[[!^]")
        return (
            F.when(sign == "*", F.lit("[^/]*")).when(sign == "?", F.lit("[^/]"))
            .when(F.length(sign) > 1, F.concat(F.when(negated, F.lit("[^/")).otherwise(F.lit("[")), inner, F.lit("]")))
            .otherwise(F.concat(F.lit("\\Q"), _shown(sign), F.lit("\\E")))
        )

    signs = F.regexp_extract_all(name, F.lit(r"(?s)(\[[^\[\]]+\]|.)"), F.lit(1))
    return F.concat(F.lit(r"\A"), F.array_join(F.transform(signs, one), ""), F.lit(r"\z"))


def _tree(file_status: DataFrame, wanted: DataFrame) -> DataFrame:
    """`parent, name, node` of every folder and file below the folders in `wanted`, each once."""
    parts = F.split("file", "/")
    files = file_status.select(_strip(F.col("path")).alias("file")).distinct()
    # A path that does not lie below a wanted folder gives no rows; the folders are few, one for each glob at most.
    tops = files.select("file", F.explode(_ancestors(F.col("file"), False)).alias("node"))
    below = tops.join(F.broadcast(wanted) if fits(wanted) else wanted, "node", "left_semi")
    highest = below.groupBy("file").agg(F.min(F.length("node")).alias("top"))
    depth = F.size(F.split(F.expr("left(file, top)"), "/"))
    step = F.explode(F.transform(F.sequence(depth + 1, F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n - 1), "/").alias("parent"), F.element_at(parts, n).alias("name"))))
    return highest.select(step.alias("edge")).select("edge.*").distinct().withColumn("node", F.concat_ws("/", "parent", "name"))


def _glob_nodes(globs: DataFrame, file_status: DataFrame) -> DataFrame:
    """`path, node`: the files and folders that each glob (`path`, and `name` without braces) matches.

    Globs walk down the tree of folders, one part in each step, from the folder before their first
    special part. A literal part is looked up by equal keys. Only a special part is compared with
    names, the different names of the one folder it stands in, and once for all globs that have come
    to this folder with this part.
    """
    parts = F.split("name", "/")
    literal = (F.array_position(F.transform(parts, lambda part: part.rlike(_SPECIAL)), True) - 1).cast("int")
    keyed = globs.select("path", parts.alias("parts"), literal.alias("done"), _shown(F.array_join(F.slice(parts, F.lit(1), literal), "/")).alias("node"))
    keyed = written(keyed, "globs")
    deepest = keyed.select(F.max(F.size("parts") - F.col("done"))).first()[0] or 0
    tree = written(_tree(file_status, keyed.select("node").distinct()), "tree")
    matched, walk = None, keyed
    for _ in range(deepest):
        at = walk.withColumn("part", F.element_at("parts", F.col("done") + 1))
        asked = at.select(F.col("node").alias("parent"), "part").distinct()
        special = F.col("part").rlike(_SPECIAL)
        exact = asked.where(~special).withColumn("name", _shown(F.col("part"))).join(tree, ["parent", "name"])
        within = asked.where(special).withColumn("regex", _glob_regex(F.col("part"))).join(tree, "parent").where(F.expr("name RLIKE regex"))
        steps = exact.select("parent", "part", F.col("node").alias("next")).unionByName(within.select("parent", "part", F.col("node").alias("next")))
        walk = at.withColumnRenamed("node", "parent").join(steps, ["parent", "part"]).select("path", "parts", (F.col("done") + 1).alias("done"), F.col("next").alias("node"))
        ended = walk.where("done = size(parts)").select("path", "node")
        matched = ended if matched is None else matched.unionByName(ended)
        walk = walk.where("done < size(parts)")
    return matched.distinct() if matched is not None else keyed.select("path", "node").where(F.lit(False))


def _permits(user: Column, action: Column) -> Column:
    read_ok = F.col("read_lo").isNull() | ((F.col("read_lo") == user) & (F.col("read_hi") == user))
    all_ok = F.col("all_lo").isNull() | ((F.col("all_lo") == user) & (F.col("all_hi") == user))
    return F.coalesce(F.when(action == "READ", read_ok).otherwise(all_ok), F.lit(False))


def uri_access(paths: DataFrame, file_status: DataFrame, schemes=FILE_SCHEMES) -> DataFrame:
    """Paths named by statements (`path, op, user_name`) with `uri_action`, `allowed` and `message`.

    Paths outside the checked schemes are left out. All existing files at or below every match must
    be the user's own or permit the action. Where nothing matches, the nearest listed parent must;
    where there is none either, or the path is no valid glob, the check has failed. Folders exist as
    parents only if the listing has a row for them.
    """
    checked = paths.where(X.in_fs_scheme("path", schemes)).withColumn("uri_action", X.uri_action())
    named = checked.withColumn("given", F.col("path")).withColumn("path", _strip(F.col("path")))
    # Many statements name one path: what follows reads the different ones, with their names without braces.
    wanted = named.where("uri_action <> 'NONE'").select("path").distinct()
    spelled = written(wanted.select("path", F.explode_outer(_names(F.col("path"))).alias("name")), "paths")
    names = spelled.where(F.col("name").isNotNull())
    special = F.col("name").rlike(_SPECIAL)

    literal = names.where(~special).select("path", _strip(_shown(F.col("name"))).alias("node"))
    matched = written(_glob_nodes(names.where(special), file_status), "matched")
    literal = literal.unionByName(matched)
    # Parents are those of the path as it is written; a path that is no valid glob has none.
    upwards = names.select("path").distinct().select("path", F.explode(_ancestors(F.col("path"), False)).alias("node"))
    # Many paths share their upper folders, so the nodes they meet are reduced to those first.
    reached = folder_summaries(file_status, literal.select("node").unionByName(upwards.select("node")).distinct())
    exact = literal.join(reached, "node").select("path", *_SUMMARY)
    listed = reached.where(F.col("own").isNotNull()).select("node", "own")
    parents = upwards.join(listed, "node").groupBy("path").agg(F.max_by("own", F.length("node")).alias("parent"))
    matches = _summarize(exact, ["path"]).select("path", F.struct(*_SUMMARY).alias("matched"))
    found = matches.join(parents, "path", "full").select("path", F.coalesce("matched", "parent").alias("found"))

    answered = named.join(found, "path", "left").select("*", "found.*").withColumn("path", F.col("given"))
    permitted = F.col("found").isNotNull() & _permits(F.col("user_name"), F.col("uri_action"))
    return (
        answered.withColumn("allowed", (F.col("uri_action") == "NONE") | permitted)
        .withColumn("message", F.when(~F.col("allowed"), X.uri_denial_message()))
        .drop("given", "found", *_SUMMARY)
    )
