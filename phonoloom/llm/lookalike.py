"""Text that looks the same in different characters, brought to one form.

Values are mapped by built-in string functions (full-width forms, look-alike letters, fixed-width spaces and characters that
show nothing), the mapped values are grouped under the accent-sensitive Unicode collation (which also joins composed and
decomposed accents), each class gets a deterministic canonical member, and that member is joined back to every row.

The collation cannot be hashed by what it compares, so only mapped forms that share a key with another form are grouped by it.
The key (``bones``) is necessary for equality: it leaves out whatever equal forms may write in different ways. Everything works
on distinct values; rows meet the result at the end.

Defined results: null has the form null; an empty text and one of invisible characters only look the same. Letter case, lost
accents, raised digits, other weights and slants of letters and every other visible change keep values apart. Rows that come
twice give the same result twice in ``canonical_forms`` and count once in the ``found`` queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonoloom.llm.forms import FULLWIDTH, INVISIBLE, SPACES, looks_like
from phonoloom.session import stored

COLLATION = "UNICODE"
#: So many rows of words or hashes at most are broadcast; more are shuffled.
BROADCAST_ROWS = 200_000


def _class_text(chars) -> str:
    """Characters as ranges of a character class: a regex tests them one after another."""
    codes, out = sorted(set(map(ord, chars))), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\x{{{a:04X}}}" + (f"-\\x{{{b:04X}}}" if b > a else "") for a, b in out)


#: Characters that the canonical member should not have: they have a usual counterpart.
ODD = f"[{_class_text([*FULLWIDTH, *map(chr, [*INVISIBLE, *SPACES])])}\\p{{Mn}}]"
#: A letter of one script next to a letter of another.
MIXED = r"(?:\p{IsLatin}\p{M}*[\p{IsCyrillic}\p{IsGreek}]|[\p{IsCyrillic}\p{IsGreek}]\p{M}*\p{IsLatin})"
#: Marks around a word: everything but letters, digits, accents and characters that show nothing.
OUTER = f"[^\\p{{L}}\\p{{N}}\\p{{M}}{_class_text(map(chr, INVISIBLE))}]"


def oddness(c: Column) -> Column:
    """How many characters of a text have a more usual counterpart."""
    odd = F.regexp_count(c, F.lit(ODD)) + F.regexp_count(c, F.lit(MIXED))
    return F.when(F.octet_length(c) == F.char_length(c), 0).otherwise(odd)


#: What forms that look the same may write differently: accents with what they stand on, and all characters but those (ASCII and
#: the plain letters of some scripts) that no other character or sequence equals. Digits stay too: to the collation those of all
#: scripts are equal, to the eye they are not.
_FLEXIBLE = r"\P{M}\p{M}+|[^\x09-\x0D\x20-\x7E\p{Nd}\x{0628}-\x{064A}\x{0904}-\x{0928}\x{092A}-\x{0930}\x{4E00}-\x{9FFF}]"


def bones(mapped: Column) -> Column:
    """A key that forms share if they are equal under the collation and look the same."""
    return F.regexp_replace(mapped, _FLEXIBLE, "")


def _several(values: DataFrame) -> DataFrame:
    """``mapped, form``: the mapped forms in classes of several different values, and the least form of the class. Everything
    that looks like nothing else is counted once and leaves here."""
    forms = values.filter("value IS NOT NULL").select("value").distinct().select(looks_like(F.col("value")).alias("mapped"))
    # Exactly equal mapped forms are combined first (binary keys), so the collation meets each form once.
    forms = stored(forms.groupBy("mapped").agg(F.count("*").alias("n")).withColumn("key", F.xxhash64(bones(F.col("mapped")))))
    shared = forms.groupBy("key").agg(F.count("*").alias("forms")).filter("forms > 1").select("key")
    doubtful = stored(forms.join(shared, "key", "left_semi").withColumn("class_key", F.collate("mapped", COLLATION)).select("mapped", "key", "class_key"))
    merged = doubtful.groupBy("key", "class_key").agg(F.min("mapped").alias("form"), F.count("*").alias("forms")).filter("forms > 1")
    merged = doubtful.join(merged, ["key", "class_key"]).select("mapped", "form")
    return stored(forms.join(merged, "mapped", "left").filter("n > 1 OR form IS NOT NULL").select("mapped", F.coalesce("form", "mapped").alias("form")))


def _small(df: DataFrame) -> DataFrame:
    """Written, counted and marked for a broadcast if it is small."""
    kept = stored(df)
    return F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept


def _members(values: DataFrame) -> DataFrame:
    """The rows of ``values`` whose column ``value`` is in a class of several different values, with ``canon``, its canonical
    member: the one with the fewest odd characters, and the first of those in code point order. It is the same for every order
    of rows and every partitioning."""
    several = _several(values)
    # The hashes of the forms keep all other rows from being moved.
    hashes = _small(several.select(F.xxhash64("mapped").alias("hash")).distinct())
    near = values.withColumn("mapped", looks_like(F.col("value"))).join(hashes, F.xxhash64("mapped") == F.col("hash"), "left_semi")
    member = stored(near.join(several, "mapped").drop("mapped"))
    best = F.min(F.struct(oddness(F.col("value")).alias("odd"), F.col("value")))
    canon = member.select("value", "form").distinct().groupBy("form").agg(best.alias("best"))
    return member.join(canon.select("form", F.col("best.value").alias("canon")), "form").drop("form")


def canonical_forms(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``canonical``: the canonical member of the class of ``column``, null for null."""
    known = _members(df.select(F.col(column).alias("value")).distinct()).select("value", "canon")
    # Every row keeps its columns, clashing names included: the added column is the last one.
    joined = df.join(known, df[column] == known["value"], "left")
    return joined.withColumn("canonical", F.coalesce(known["canon"], df[column])).drop(known["value"]).drop(known["canon"])


def same_look_members(df: DataFrame, key: str, column: str) -> DataFrame:
    """``k, value_id, class_id``: the keys of whole texts that look like another text but differ from it in their code points.

    ``value_id`` is the least key of the same text, ``class_id`` the least key of a text that looks the same.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("k"), F.col(column).alias("value"))
    member = stored(_members(rows).distinct())
    value = member.groupBy("value", "canon").agg(F.min("k").alias("value_id"))
    ids = value.groupBy("canon").agg(F.min("value_id").alias("class_id"))
    return stored(member.join(value.select("value", "value_id"), "value").join(ids, "canon").select("k", "value_id", "class_id"))


def same_look_pairs(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key_a, key_b``: keys, the smaller first, of whole texts that look the same and differ in their code points.

    Different texts of a class are paired first, and each pair of texts then meets the keys of both: labels of one text never
    meet each other.
    """
    member = same_look_members(df, key, column)
    text = member.select("value_id", "class_id").distinct()
    pair = text.select("class_id", F.col("value_id").alias("a")).join(text.select("class_id", F.col("value_id").alias("b")), "class_id").filter("a < b").select("a", "b")
    one, other = (member.select(F.col("value_id").alias(n), F.col("k").alias(f"k_{n}")) for n in "ab")
    found = pair.join(one, "a").join(other, "b")
    return found.select(F.least("k_a", "k_b").alias("key_a"), F.greatest("k_a", "k_b").alias("key_b")).filter("key_a < key_b").distinct()


def same_look_classes(df: DataFrame, key: str, column: str) -> DataFrame:
    """``k, class_id, links``: one row for each text of a class, and how many keys of its class have another text."""
    member = same_look_members(df, key, column)
    whole = member.groupBy("class_id").agg(F.count("*").alias("keys"))
    same = member.groupBy("class_id", "value_id").agg(F.count("*").alias("same"))
    counts = same.join(whole, "class_id").select("value_id", (F.col("keys") - F.col("same")).alias("links"))
    return member.join(counts, "value_id").select("k", "class_id", "links")


def term_lookalikes(df: DataFrame, key: str, words: Column, terms: DataFrame, term: str) -> DataFrame:
    """``key_a, key_b, canonical``: key and index of each word that, outer punctuation aside, looks like a term but differs from
    it, and the canonical member of its class.

    Distinct words are compared; the few that are found are joined back to their rows.
    """
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key_a"), F.posexplode(words).alias("key_b", "word"))
    core = F.regexp_replace("word", f"^{OUTER}+|{OUTER}+$", "")
    # Written first: filters on what is made of a word would else move below the distinct and be computed for every occurrence.
    distinct = stored(rows.select("word").distinct()).withColumn("core", core).filter("core <> ''")
    wanted = terms.filter(F.col(term).isNotNull()).select(F.col(term).alias("value")).distinct()
    keys = _small(wanted.select(bones(looks_like(F.col("value"))).alias("bones")).distinct())
    near = stored(distinct.withColumn("bones", bones(looks_like(F.col("core")))).join(keys, "bones", "left_semi").select("word", "core"))
    known = stored(_members(near.select(F.col("core").alias("value")).unionByName(wanted).distinct()))
    of_terms = known.join(wanted, "value", "left_semi").select("canon").distinct()
    found = known.join(of_terms, "canon", "left_semi").join(wanted, "value", "left_anti")
    hits = _small(near.join(found, F.col("core") == F.col("value")).select("word", F.col("canon").alias("canonical")))
    return rows.join(hits, "word").select("key_a", F.col("key_b").cast("bigint").alias("key_b"), "canonical").distinct()
