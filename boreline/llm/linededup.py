"""Line dedup by a fixed-depth tree of log templates, in DataFrame functions only.

A line's tokens that hold a digit are fields already. Two things recur:

1. A wording, of any length, that ``MIN_DOCS`` documents have.
2. A template. The tree has a level for the number of tokens and one for each
   of the leading words; a leading word that is rare below its branch goes to
   a field's branch. In a leaf, a token stays at its place if most of the
   leaf's documents have it there, and becomes a field if not: a share, so a
   field's values do not pass for fixed words in a large table. At least half
   of the tokens must stay. Lines of any length have templates.

Lines that recur are dropped. A document, that is a key and a text, that has no
other lines keeps those that are the first of their kind in such documents; or
all of them, where copies of whole documents are somebody else's business.

Wordings travel as two 64-bit digests and tokens as one; the text of a line is
read once to take them, and once to cut it. Most leaves have no template: a
vote on short codes of tokens finds those that may have one, and only their
tokens are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import drop_stored, text_of
from boreline.session import stored

#: The query's SQL looks for templates among lines of so many tokens at most; the operator among all.
MAX_TOKENS = 24
#: Leading words that choose the leaf.
DEPTH = 3
PATH = [f"word{k}" for k in range(DEPTH)]
#: Documents that a wording, a template, and a leading word below its branch must occur in.
MIN_DOCS = 10
#: A token stays if more than this share of its leaf's documents have it at its place.
SHARE = 0.5
#: Share of a template's tokens that are no fields.
MIN_FIXED = 0.5
#: Documents of a leaf that vote together, on average, and places that they vote on at once.
VOTERS, PLACES = 64, 1024
#: Digests sent to every task, so that no other texts are shuffled; where there are more, all texts are.
SENT = 4_000_000
#: Share of a line's leading tokens that have no vote; less than MIN_FIXED.
UNASKED = 0.4
#: The code of a field; those of other tokens are less, and equal for equal tokens.
FIELD = 127


def masked(line: Column) -> Column:
    """Single spaces between tokens, and a field for each token with a digit."""
    uneven = F.contains(line, F.lit("  ")) | F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r"))
    even = F.trim(F.when(uneven, F.regexp_replace(line, r"[ \t\r]+", " ")).otherwise(line))
    return F.when(even.rlike("[0-9]"), F.regexp_replace(even, r"[^ ]*[0-9][^ ]*", "<*>")).otherwise(even)


def _digests(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _numbered_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """The lines of each document: ``doc``, ``mark`` (digest of the text), ``line``, the wording, its digests, its number of tokens and digests of its leading words."""
    lines = df.select(F.col(key).alias("doc"), F.xxhash64(text_of(text)).alias("mark"), F.posexplode(F.split(text_of(text), "\n")).alias("line", "raw"))
    # Asked of the raw line, or Spark would take the wording twice.
    lines = lines.where(F.col("raw").rlike(r"[^ \t\r]")).select("doc", "mark", "line", masked(F.col("raw")).alias("wording"))
    size = F.length("wording") - F.length(F.replace("wording", F.lit(" "))) + 1
    words = F.when(F.contains("wording", F.lit("<*>")), F.regexp_replace("wording", r"(?<![^ ])<\*>(?: |$)", "")).otherwise(F.col("wording"))
    lines = lines.withColumn("path", F.split(F.substring_index(words, " ", DEPTH), " "))
    path = [F.when(F.get("path", F.lit(k)) != "", F.xxhash64(F.get("path", F.lit(k)))).alias(c) for k, c in enumerate(PATH)]
    return lines.select("doc", "mark", "line", *_digests("wording"), size.alias("size"), *path, "wording")


def _leaves(wordings: DataFrame) -> DataFrame:
    """The leaf of each wording: its number of tokens, then its leading words as far as they are frequent on the way."""
    placed = wordings.withColumn("leaf", F.col("size").cast("bigint"))
    for token in PATH:
        common = placed.where(F.col(token).isNotNull()).groupBy("leaf", token).agg(F.sum("docs").alias("n")).where(F.col("n") >= MIN_DOCS)
        # Written, so that the join knows its size or can split a hot branch.
        common = stored(common.select("leaf", token, F.lit(1).alias("common")), "branches")
        step = F.when(F.col("common") == 1, F.col(token))
        placed = placed.join(common, ["leaf", token], "left").withColumn("leaf", F.xxhash64("leaf", step)).drop(token, "common")
    return placed


def _voted(rows: str) -> Column:
    """From the codes of several lines, the places (from 0) of codes that most of them have, but fields.

    Lines of different codes cancel each other out, so at most one code of a
    place is left, and one that most have is; then the lines that have it are
    counted. A number holds what is left of the lines and, in its last bits,
    the code.
    """

    def vote(a: Column, c: Column) -> Column:
        return F.when(a <= FIELD, c + F.lit(FIELD + 1)).when(a.bitwiseAND(FIELD) == c, a + (FIELD + 1)).otherwise(a - (FIELD + 1))

    none = F.transform(F.get(rows, F.lit(0))["codes"], lambda c: F.lit(FIELD))
    left = F.aggregate(rows, none, lambda acc, row: F.zip_with(acc, row["codes"], vote))
    places = F.transform(left, lambda a, k: F.when((a > FIELD) & (a.bitwiseAND(FIELD) != FIELD), F.struct(k.alias("place"), a.bitwiseAND(FIELD).alias("code"))))

    def most(x: Column) -> Column:
        return F.size(F.filter(rows, lambda row: F.get(row["codes"], x["place"]) == x["code"])) > SHARE * F.size(rows)

    return F.transform(F.filter(places, lambda x: x.isNotNull() & most(x)), lambda x: x["place"])


def _likely(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """``leaf`` and ``total`` of the leaves that may have a template.

    The documents of a leaf vote in groups. A token that most documents have
    is one that most of some group have, so a leaf of too few such places has
    no template, whatever the tokens that were not asked for.
    """
    leaves = stored(placed.groupBy("leaf", "size").agg(F.sum("docs").alias("total")).where(F.col("total") >= MIN_DOCS), "leaves")
    asked = F.col("size") - F.floor(UNASKED * F.col("size")).cast("int")
    tail = F.call_function("substring_index", F.col("wording"), F.lit(" "), -asked)
    codes = F.transform(F.split(tail, " "), lambda t: F.when(t == "<*>", FIELD).otherwise(F.pmod(F.xxhash64(t), F.lit(FIELD))).cast("tinyint"))
    coded = lines.select("h1", "h2", F.xxhash64("doc", "mark").alias("owner"), codes.alias("codes"))
    coded = coded.join(placed.join(leaves, ["leaf", "size"]).select("h1", "h2", "leaf", "size", "total"), ["h1", "h2"])
    group = F.pmod(F.col("owner").bitwiseXOR(F.col("h1")), F.greatest(F.floor(F.col("total") / VOTERS), F.lit(1))).alias("group")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("codes") - 1) / PLACES).cast("int")), lambda k: F.slice("codes", k * PLACES + 1, PLACES))
    parts = coded.select("leaf", "size", group, "owner", "h1", F.posexplode(parts).alias("part", "codes"))
    # A set: a document that has a line twice votes once.
    votes = parts.groupBy("leaf", "size", "group", "part").agg(F.collect_set(F.struct("owner", "h1", "codes")).alias("rows"))
    places = votes.select("leaf", "size", "part", F.explode(_voted("rows")).alias("place")).distinct()
    enough = places.groupBy("leaf", "size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_FIXED * F.col("size") - F.floor(UNASKED * F.col("size")))
    out = stored(leaves.join(enough, ["leaf", "size"]).select("leaf", "total"), "likely-leaves")
    drop_stored(lines.sparkSession, leaves)
    return out


def _templates(lines: DataFrame, wordings: DataFrame) -> DataFrame:
    """The template of each wording that has one."""
    leaves = stored(_leaves(wordings), "leaves-of-wordings")
    likely = _likely(lines, leaves)
    few = stored(leaves.join(likely, "leaf").select("h1", "h2", "leaf", "total", "docs"), "likely-wordings")
    texts = lines.select("h1", "h2", "wording")
    if few.count() <= SENT:
        texts = texts.join(F.broadcast(few.select("h1").distinct()), "h1", "left_semi")
    placed = stored(texts.join(few, ["h1", "h2"]).distinct(), "placed")
    tokens = placed.select("leaf", "total", "docs", F.posexplode(F.split("wording", " ")).alias("place", "token")).where("token != '<*>'")
    counted = tokens.groupBy("leaf", "total", "place", F.xxhash64("token").alias("token")).agg(F.sum("docs").alias("n"))
    # At most one token of a place is in most documents, so a leaf has no more of them than a line has tokens.
    fixed = counted.where(F.col("n") > SHARE * F.col("total")).groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("place", "token"))).alias("fixed"))
    # As an array by place, with nulls between: a map's lookup would pass all its keys.
    gap = lambda x, k: x["place"] - F.when(k == 0, -1).otherwise(F.get("fixed", k - 1)["place"]) - 1
    filled = F.transform("fixed", lambda x, k: F.concat(F.array_repeat(F.lit(None).cast("bigint"), gap(x, k)), F.array(x["token"])))
    fixed = stored(fixed.select("leaf", F.flatten(filled).alias("fixed")), "fixed-tokens")
    shaped = placed.join(fixed, "leaf").select("h1", "h2", "fixed", F.split("wording", " ").alias("tokens"))
    shown = F.transform("tokens", lambda t, k: F.when((t != "<*>") & (F.get("fixed", k) == F.xxhash64(t)), t).otherwise("<*>"))
    shaped = shaped.select("h1", "h2", shown.alias("tokens")).where(F.size(F.filter("tokens", lambda t: t != "<*>")) >= MIN_FIXED * F.size("tokens"))
    shaped = stored(shaped.select("h1", "h2", F.array_join("tokens", " ").alias("template")), "templates")
    for used in (leaves, likely, few, placed, fixed):
        drop_stored(lines.sparkSession, used)
    return shaped


def recurring_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``mark``, ``line`` (from 0), ``kind`` and ``template`` of every line that recurs.

    A document is a key and a text; it counts once for each wording and each
    template. ``kind`` is a digest of the template where that recurs, and of
    the wording where only that does (``template`` is null then).
    """
    spark = df.sparkSession
    lines = stored(_numbered_lines(df, key, text), "lines")
    owned = lines.select("h1", "h2", "size", *PATH, "doc", "mark").distinct()
    wordings = stored(owned.groupBy("h1", "h2", "size", *PATH).agg(F.count(F.lit(1)).alias("docs")), "wordings")
    shaped = _templates(lines, wordings)
    known = wordings.select("h1", "h2", (F.col("docs") >= MIN_DOCS).alias("often")).join(shaped, ["h1", "h2"], "left").where("often or template is not null")
    found = stored(lines.select("doc", "mark", "line", "h1", "h2").join(known, ["h1", "h2"]), "found-lines")
    owners = found.where("template is not null").select("template", "doc", "mark").distinct()
    recurs = stored(owners.groupBy("template").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS).select(F.col("template").alias("recurring")), "recurring-templates")
    both = found.join(recurs, F.col("template") == F.col("recurring"), "left").where("often or recurring is not null")
    kind = F.when(F.col("recurring").isNotNull(), F.xxhash64("recurring")).otherwise(F.col("h1"))
    out = stored(both.select("doc", "mark", "line", kind.alias("kind"), F.col("recurring").alias("template")), "recurring-lines")
    for used in (lines, wordings, shaped, found, recurs):
        drop_stored(spark, used)
    return out


def dropped_lines(df: DataFrame, key: str = "doc_id", text: str = "text", keep_copies: bool = False) -> DataFrame:
    """``doc``, ``mark`` and ``flags`` of the documents that lose lines: a character for each line up to the last that goes, ``1`` for those that go."""
    spark = df.sparkSession
    found = recurring_lines(df, key, text)
    solid = F.size(F.filter(F.split(text_of(text), "\n"), lambda line: line.rlike(r"[^ \t\r]")))
    sizes = df.select(F.col(key).alias("doc_"), F.xxhash64(text_of(text)).alias("mark_"), solid.alias("solid"))
    hits = found.groupBy("doc", "mark").agg(F.count_distinct("line").alias("hits"))  # repeated rows have their lines twice
    same = F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("mark") == F.col("mark_"))
    whole = stored(hits.join(sizes, same).where("hits = solid").select(F.col("doc").alias("doc_"), F.col("mark").alias("mark_")).distinct(), "whole-documents")
    left = found.join(whole, same, "left_anti").select("doc", "mark", "line")
    if not keep_copies:
        inside = found.join(whole, same, "left_semi")
        place = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark", "line")
        first = inside.groupBy("kind").agg(F.min(place).alias("first")).select(F.col("first.doc").alias("doc_"), F.col("first.mark").alias("mark_"), F.col("first.line").alias("line_"))
        left = left.unionByName(inside.join(first, same & (F.col("line") == F.col("line_")), "left_anti").select("doc", "mark", "line"))
    lines = left.groupBy("doc", "mark").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    flags = F.transform("lines", lambda line, k: F.concat(F.repeat(F.lit("0"), line - F.when(k == 0, -1).otherwise(F.get("lines", k - 1)) - 1), F.lit("1")))
    out = stored(lines.select("doc", "mark", F.size("lines").cast("bigint").alias("n"), F.array_join(flags, "").alias("flags")), "dropped-lines")
    for used in (found, whole):
        drop_stored(spark, used)
    return out


def without_recurring_lines(df: DataFrame, key: str = "doc_id", text: str = "text", keep_copies: bool = False) -> DataFrame:
    """The rows with recurring lines cut out of their texts, and ``n_lines``, ``n_dropped`` beside.

    Null texts stay null and count as no lines, as empty ones do; blank lines
    are kept. Repeated rows lose the same lines; rows of one key with
    different texts are told apart by their texts. A document of recurring
    lines alone keeps those that are first of their kind in such documents
    (by key, rows without a key last), or with ``keep_copies`` all of them.
    Other columns pass through, but for those named like the two counts,
    which these replace.
    """
    df = df.drop("n_lines", "n_dropped")
    dropped = dropped_lines(df, key, text, keep_copies)
    marked = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")).withColumn("mark", F.xxhash64(text_of(f"row.`{text}`")))
    both = marked.join(dropped, marked[f"row.{key}"].eqNullSafe(dropped["doc"]) & (marked["mark"] == dropped["mark"]), "left").select("row", "n", "flags")
    parts = F.split(text_of(f"row.`{text}`"), "\n")
    solid = F.size(F.filter(parts, lambda line: line.rlike(r"[^ \t\r]")))
    paired = F.zip_with(parts, F.split("flags", ""), lambda line, flag: F.struct(line.alias("line"), flag.alias("flag")))
    # Flags may be fewer than lines, and end with an empty one.
    stays = F.filter(paired, lambda x: x["line"].isNotNull() & ~x["flag"].eqNullSafe(F.lit("1")))
    kept = F.array_join(F.transform(stays, lambda x: x["line"]), "\n")
    changed = [F.when(F.col("flags").isNull(), F.col(f"row.`{c}`")).otherwise(kept).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    return both.select(*changed, solid.cast("bigint").alias("n_lines"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_dropped"))


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_recurring_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("clean_sha256"))


def _level(k: int) -> str:
    """One leading word more: it stays if it is frequent below the branch so far."""
    before = "wordings" if k == 1 else f"level{k - 1}"
    return f"""level{k} AS (
  SELECT wording, tokens, words, docs, CASE WHEN len(words) >= {k} AND sum(docs) OVER (PARTITION BY leaf, words[{k}]) >= {MIN_DOCS} THEN leaf || ' ' || words[{k}] ELSE leaf || ' <*>' END AS leaf
  FROM {before}),"""


LEVELS = "\n".join(_level(k) for k in range(1, DEPTH + 1))
ORACLE = rf"""
WITH raw AS (SELECT doc_id, row_number() OVER () AS n, dense_rank() OVER (ORDER BY doc_id NULLS LAST, coalesce(text, '')) AS d, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, n, d, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM raw),
words AS (SELECT *, regexp_replace(trim(regexp_replace(raw, '[ \t\r]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS wording FROM lines),
counted AS (SELECT wording, string_split(wording, ' ') AS tokens, count(DISTINCT d) AS docs FROM words WHERE wording <> '' GROUP BY 1),
wordings AS (SELECT wording, tokens, list_filter(tokens, lambda t: t <> '<*>') AS words, docs, len(tokens)::VARCHAR AS leaf FROM counted WHERE len(tokens) <= {MAX_TOKENS}),
{LEVELS}
leaves AS (SELECT leaf, sum(docs) AS total FROM level{DEPTH} GROUP BY 1 HAVING sum(docs) >= {MIN_DOCS}),
tokens AS (SELECT leaf, total, wording, docs, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM level{DEPTH} JOIN leaves USING (leaf)),
fixed AS (SELECT leaf, place, token FROM tokens WHERE token <> '<*>' GROUP BY 1, 2, 3 HAVING sum(docs) > {SHARE} * any_value(total)),
shaped AS (
  SELECT t.wording, string_agg(CASE WHEN f.token IS NULL THEN '<*>' ELSE t.token END, ' ' ORDER BY t.place) AS template
  FROM tokens t LEFT JOIN fixed f ON t.leaf = f.leaf AND t.place = f.place AND t.token = f.token
  GROUP BY t.leaf, t.wording HAVING count(f.token) >= {MIN_FIXED} * count(*)),
recurs AS (SELECT template FROM words JOIN shaped USING (wording) GROUP BY 1 HAVING count(DISTINCT d) >= {MIN_DOCS}),
gone AS (
  SELECT w.*, CASE WHEN w.wording = '' THEN NULL WHEN r.template IS NOT NULL THEN 't' || r.template WHEN c.docs >= {MIN_DOCS} THEN 'w' || w.wording END AS kind
  FROM words w LEFT JOIN shaped s USING (wording) LEFT JOIN recurs r ON r.template = s.template LEFT JOIN counted c ON c.wording = w.wording),
whole AS (SELECT d FROM gone GROUP BY 1 HAVING count(kind) = count(*) FILTER (wording <> '') AND count(kind) > 0),
first AS (SELECT kind, min((d, line)) AS p FROM gone WHERE kind IS NOT NULL AND d IN (SELECT d FROM whole) GROUP BY 1),
decided AS (SELECT g.*, g.kind IS NOT NULL AND NOT (g.d IN (SELECT d FROM whole) AND (g.d, g.line) = f.p) AS goes FROM gone g LEFT JOIN first f USING (kind)),
cut AS (SELECT n, count(*) FILTER (wording <> '') AS n_lines, count(*) FILTER (goes) AS n_dropped, coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (NOT goes), '') AS kept FROM decided GROUP BY 1)
SELECT r.doc_id, c.n_lines, c.n_dropped, sha256(CASE WHEN n_dropped > 0 THEN kept ELSE text END) AS clean_sha256 FROM raw r JOIN cut c USING (n)
"""
