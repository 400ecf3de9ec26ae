"""Exact substring, prefix and whole-word matching of many keys against texts,
through an inverted index of ids.

Spark has no index for ``text LIKE '%' || key || '%'``; as a join condition it
plans as a nested loop. Here texts list pieces of themselves, a text that holds a
key holds the key's pieces, and only (piece, text id) rows are joined:

* a key's inner words (runs of letters and digits with other characters on both
  sides) are whole words of the text; where a key has none, the first ``GRAM``
  characters of its last run begin a word of the text and the last ``GRAM`` of its
  first run end one; other keys have the runs of ``GRAM`` characters (shorter keys:
  single characters) that start at every place;
* of its pieces a key's anchor is the one that the fewest texts hold; a key with a
  piece that no text holds is found nowhere;
* a text is fetched once per candidate, by its hash, and tested in full.

The keys and the index (pieces that some key has, with text hashes) are written
to the checkpoint folder, as several steps read them; of them only the kinds of
keys there are reach the driver. Modes: ``contains``; ``prefix`` (texts list their
beginnings of the lengths that keys have); ``word`` (keys made of ``[a-z0-9_]`` are
looked up among the texts' tokens, others as ``contains`` with a test of what
stands on either side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.session import materialize

GRAM = 4
_RUN = "[A-Za-z0-9]+"
_INNER = "(?<=[^A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])"
_LAST = "[^A-Za-z0-9]([A-Za-z0-9]{%d})[A-Za-z0-9]*$" % GRAM
_FIRST = "^[A-Za-z0-9]*([A-Za-z0-9]{%d})[^A-Za-z0-9]" % GRAM
_EVERY = r"(?=([\s\S]{%d}))"


def _keys(keys: DataFrame, key_col: str, group: Column) -> DataFrame:
    return (keys.select(group.alias("grp"), F.col(key_col).alias("key"))
            .where(F.col("key").isNotNull() & (F.length("key") > 0)).distinct())


def _all(text: str | Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), group)


def _marked(mark: str, pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.concat(F.lit(mark), p))


def _key_pieces(keys: DataFrame) -> DataFrame:
    """Keys with their pieces and the kind of these: word, edge, gram or sign."""
    inner = _marked("=", _all("key", _INNER))
    edges = F.concat(_marked("^", _all("key", _LAST, 1)), _marked("$", _all("key", _FIRST, 1)))
    rest = F.when(F.length("key") >= GRAM, _marked("*", _all("key", _EVERY % GRAM, 1))).otherwise(
        _marked(".", _all("key", _EVERY % 1, 1)))
    kind = (F.when(F.size(inner) > 0, "word").when(F.size(edges) > 0, "edge")
            .when(F.length("key") >= GRAM, "gram").otherwise("sign"))
    pieces = F.when(F.size(inner) > 0, inner).when(F.size(edges) > 0, edges).otherwise(rest)
    return keys.select("grp", "key", kind.alias("kind"), F.array_distinct(pieces).alias("pieces"))


def _text_pieces(kinds: set[str]) -> Column:
    """A text's pieces of the kinds that keys have."""
    words = F.array_distinct(_all("text", _RUN))
    long = F.filter(words, lambda w: F.length(w) >= GRAM)
    parts = {"word": [_marked("=", words)],
             "edge": [F.transform(long, lambda w: F.concat(F.lit("^"), F.left(w, F.lit(GRAM)))),
                      F.transform(long, lambda w: F.concat(F.lit("$"), F.right(w, F.lit(GRAM))))],
             "gram": [_marked("*", _all("text", _EVERY % GRAM, 1))],
             "sign": [_marked(".", _all("text", _EVERY % 1, 1))]}
    return F.array_distinct(F.concat(*[p for k in sorted(kinds) for p in parts[k]]))


def _containing(texts: DataFrame, keys: DataFrame) -> DataFrame | None:
    """(tid, grp, key, text) of each text that contains the key; None without keys."""
    keyed = materialize(_key_pieces(keys))
    kinds = {r.kind for r in keyed.select("kind").distinct().collect()}  # four at most
    if not kinds:
        return None
    wanted = keyed.select("grp", "key", F.size("pieces").alias("n_pieces"), F.explode("pieces").alias("piece"))
    named = texts.withColumn("hash", F.xxhash64("text"))
    index = materialize(named.select("grp", "hash", F.explode(_text_pieces(kinds)).alias("piece"))
                        .join(wanted.select("grp", "piece").distinct(), ["grp", "piece"], "left_semi").distinct())
    held = index.groupBy("grp", "piece").agg(F.count("*").alias("texts"))
    anchors = (wanted.join(held, ["grp", "piece"]).groupBy("grp", "key", "n_pieces")
               .agg(F.count("*").alias("found"), F.min(F.struct("texts", "piece")).alias("best"))
               .where("found = n_pieces").select("grp", "key", F.col("best.piece").alias("piece")))
    candidates = index.join(anchors, ["grp", "piece"]).select("grp", "hash", "key")
    return named.join(candidates, ["grp", "hash"]).where(F.contains("text", F.col("key"))).select("tid", "grp", "key", "text")


def keys_found_in(texts: DataFrame, text_col: str, keys: DataFrame, key_col: str,
                  mode: str = "contains", group_col: str | None = None,
                  text_id_col: str | None = None) -> DataFrame:
    """Distinct ``(tid, grp, key)`` such that ``key`` occurs in a text of group ``grp``.

    ``mode``: ``contains`` (substring), ``prefix`` (text starts with key) or
    ``word`` (substring bounded by characters outside ``[a-z0-9_]``).
    Without ``group_col`` every key is looked up in every text and ``grp`` is ''.
    ``tid`` is the text's ``text_id_col`` value ('' without one). Empty and
    NULL keys never match.
    """
    group = F.col(group_col).cast("string") if group_col is not None else F.lit("")
    key_df = _keys(keys, key_col, group)
    tid = F.col(text_id_col).cast("string") if text_id_col else F.lit("")
    text_df = texts.select(tid.alias("tid"), group.alias("grp"), F.col(text_col).alias("text")).where("text is not null")
    if mode == "prefix":
        lengths = key_df.agg(F.collect_set(F.length("key")).alias("lens")).withColumn("_one", F.lit(1))
        some = F.filter("lens", lambda n: n <= F.length("text"))
        heads = text_df.withColumn("_one", F.lit(1)).join(F.broadcast(lengths), "_one").select(  # one row
            "tid", "grp", F.explode(F.transform(some, lambda n: F.left("text", n))).alias("key"))
        return heads.join(key_df, ["grp", "key"], "left_semi").distinct()
    if mode == "contains":
        found = _containing(text_df, key_df)
    else:
        key_df = materialize(key_df)
        plain = F.col("key").rlike("^[a-z0-9_]+$")
        tokens = text_df.select("tid", "grp", F.explode(F.array_distinct(F.split("text", "[^a-z0-9_]+"))).alias("key"))
        whole = tokens.join(key_df.where(plain), ["grp", "key"], "left_semi")
        bounded = F.concat(F.lit(r"(?<![a-z0-9_])\Q"), F.col("key"), F.lit(r"\E(?![a-z0-9_])"))
        special = _containing(text_df, key_df.where(~plain))
        if special is None:
            return whole.distinct()
        found = whole.unionByName(special.where(F.regexp_like("text", bounded)).select("tid", "grp", "key"))
    if found is None:
        return key_df.select(F.lit("").alias("tid"), "grp", "key").limit(0)
    return found.select("tid", "grp", "key").distinct()
