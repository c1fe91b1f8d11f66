"""Rendering of cards: Column expressions, so a deck is one narrow plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import NOTE_FIELDS, PLAIN_FIELDS

NO_DEFINITION = "(no definition)"
DERIVED = ["Afledninger", "Sammensætninger", "Øvrige"]  # fixed values: the categories that a card shows


def or_placeholder(definition: Column) -> Column:
    return F.coalesce(F.nullif(definition, F.lit("")), F.lit(NO_DEFINITION))


def translated(text: Column, lemma: Column, gloss: Column) -> Column:
    """The text, with its translation below it if there is one."""
    block = F.concat(F.lit('<div class="translation">'), tx.sanitize(lemma), F.lit(" ("), tx.sanitize(gloss), F.lit(")</div>"))
    return F.concat(text, F.when(lemma.isNull() & gloss.isNull(), "").otherwise(block))


def pronunciations(items: Column) -> Column:
    """Rows for an array of (ipa, label, path); items without ipa are left out, sound is for mapped files."""

    def row(x: Column) -> Column:
        core = tx.strip(tx.strip_set(tx.sanitize(x.ipa), "[]"))
        label = F.when(tx.truthy(x.label), F.concat(F.lit('<span class="ipa-label">('), tx.sanitize(x.label), F.lit(")</span>"))).otherwise("")
        sound = F.when(x.path.isNotNull(), F.concat(F.lit("[sound:"), tx.basename(x.path), F.lit("]"))).otherwise("")
        return F.concat(F.lit('<div class="ipa-row"><span class="ipa-text">['), core, F.lit("]</span>"), label, sound, F.lit("</div>"))

    return F.array_join(F.transform(F.filter(items, lambda x: tx.sanitize(x.ipa) != ""), row), "")


def definitions(items: Column, translations: Column | None = None) -> Column:
    """Numbered definitions; translations: a map from definition to (lemma, gloss)."""

    def line(d: Column) -> Column:
        text = tx.strip(F.concat(tx.sanitize(d.number), F.lit(" "), tx.sanitize(d.definition)))
        if translations is None:
            return text
        hit = F.try_element_at(translations, d.definition)
        return translated(text, hit.lemma, hit.gloss)

    return F.array_join(F.transform(F.filter(items, lambda d: tx.sanitize(d.definition) != ""), line), "<br>")


def collocations(items: Column, translations: Column | None = None) -> Column:
    def line(x: Column) -> Column:
        if translations is None:
            return tx.sanitize(x.expression)
        hit = F.try_element_at(translations, x.expression)
        return translated(tx.sanitize(x.expression), hit.lemma, hit.gloss)

    return F.array_join(F.transform(F.filter(items, lambda x: tx.truthy(x.expression)), line), "; " if translations is None else "<br>")


def categories(derivations: Column, names: list[str]) -> Column:
    """The lists of these categories one after another."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(F.try_element_at(derivations, F.lit(n)), none) for n in names])


def pos_label(pos: Column, translation: Column) -> Column:
    both = tx.truthy(pos) & tx.truthy(translation)
    return F.when(both, F.concat(tx.sanitize(pos), F.lit(" ("), tx.sanitize(translation), F.lit(")"))).otherwise(tx.sanitize(pos))


def footer(language: Column, year: Column, chinese: str = "使用", other: str = "Made with") -> Column:
    return F.concat(F.when(F.lower(language) == "chinese", chinese).otherwise(other), F.lit(" "), year.cast("string"))


def notes(df: DataFrame, fields: dict[str, Column], guid: Column) -> DataFrame:
    """The card's fields in order, empty where none is given, and its guid."""
    return df.select(*[F.coalesce(fields.get(f, F.lit("")), F.lit("")).alias(f) for f in NOTE_FIELDS], guid.alias("guid"))


def _firsts() -> dict[str, Column]:
    """The first grammar and the first example of an entry's definitions."""
    texts = F.transform("definitions", lambda d: F.coalesce(F.transform(d.examples, lambda x: x.text), F.array().cast("array<string>")))
    return {"Grammar": tx.sanitize(tx.first_nonempty(F.transform("definitions", lambda d: d.grammar))), "Example": tx.first_nonempty(F.transform(F.flatten(texts), tx.sanitize))}


def _with_sounds(entries: DataFrame, audio: DataFrame, position: str) -> DataFrame:
    """entries with `_sounds`, their pronunciations (ipa, label, path) in order; of several files of one address, the least counts."""
    audio = audio.groupBy(F.col("url").alias("_url")).agg(F.min("path").alias("path"))
    sounds = entries.select(F.col(position).alias("_position"), F.posexplode("udtale").alias("_i", "_u")).join(audio, F.col("_u.audio") == F.col("_url"), "left")
    sounds = sounds.groupBy("_position").agg(F.array_sort(F.collect_list(F.struct("_i", F.col("_u.ipa").alias("ipa"), F.col("_u.label").alias("label"), "path"))).alias("_sounds"))
    empty = F.array().cast("array<struct<_i:int,ipa:string,label:string,path:string>>")
    return entries.join(sounds, entries[position] == sounds["_position"], "left").withColumn("_sounds", F.coalesce("_sounds", empty))


def cards(entries: DataFrame, audio: DataFrame, pos: DataFrame, definition_tr: DataFrame, expression_tr: DataFrame, language: str, position: str = "ord") -> DataFrame:
    """Notes of ranked entries (with `frequency_rank` and the position column). Translations are joined as one map a headword, so definitions stay in place.
    Headwords meet without the white space around them; of several translations of one text, that whose headword has none wins, then the least.
    Of several translations of a label, or files of one address, the least counts."""
    none = F.array().cast("array<string>")

    def pairs(rows: DataFrame, k: str, hw: str, name: str) -> DataFrame:
        bare = tx.strip(F.col("headword"))
        one = rows.where(F.col(k).isNotNull()).groupBy(bare.alias(hw), k).agg(F.min(F.struct((F.col("headword") != bare).alias("padded"), "lemma", "gloss")).alias("w"))
        return one.groupBy(hw).agg(F.map_from_entries(F.collect_list(F.struct(F.col(k), F.struct("w.lemma", "w.gloss")))).alias(name))

    defs, exprs = pairs(definition_tr, "definition", "_hw", "_defs"), pairs(expression_tr, "expression", "_hw2", "_exprs")
    pos = pos.groupBy("pos").agg(F.min("pos_tr").alias("pos_tr"))
    e = _with_sounds(entries, audio, position).withColumn("_key", tx.strip(F.col("headword")))
    e = e.join(defs, e["_key"] == defs["_hw"], "left").join(exprs, e["_key"] == exprs["_hw2"], "left").join(pos.withColumnRenamed("pos", "_pos"), F.col("pos") == F.col("_pos"), "left")
    definition = definitions(F.col("definitions"), F.col("_defs"))
    fields = {
        "Headword": tx.sanitize(F.col("headword")),
        "POS": pos_label(F.col("pos"), F.col("pos_tr")),
        "IPA": pronunciations(F.col("_sounds")),
        "Definition": F.when(tx.truthy(F.col("_key")), or_placeholder(definition)).otherwise(definition),
        **_firsts(),
        "Variants": tx.join_safe(F.col("wordforms")),
        "Collocations": collocations(F.col("fixed_expressions"), F.col("_exprs")),
        "Derivatives": tx.join_safe(F.coalesce(categories(F.col("orddannelser"), DERIVED), none), ", "),
        "Etymology": F.coalesce(tx.ellipsis(F.col("etymology.raw")), F.lit("")),
        "FrequencyRank": tx.rank_text(F.col("frequency_rank")),
    }
    guid = tx.guid(tx.sanitize(F.col("headword")), F.concat(tx.sanitize(F.col("pos")), F.lit(f"-{language.lower()}")))
    out = e.select(position, "frequency_rank", *[F.coalesce(fields[f], F.lit("")).alias(f) for f in NOTE_FIELDS], guid.alias("guid"))
    return out.orderBy(F.col("frequency_rank").asc_nulls_last(), position).drop(position, "frequency_rank")


def plain_cards(entries: DataFrame, audio: DataFrame, position: str = "ord") -> DataFrame:
    """Notes without translations and rank, of entries in the order of a word list (with `rank` and the position column). Lists are joined as
    they are, empty items included; an etymology always ends with the mark."""
    e = _with_sounds(entries, audio, position)
    none = F.array().cast("array<string>")
    headword, pos = tx.sanitize(F.col("headword")), tx.sanitize(F.col("pos"))
    fields = {
        "Headword": headword,
        "POS": pos,
        "IPA": pronunciations(F.col("_sounds")),
        "Definition": or_placeholder(definitions(F.col("definitions"))),
        **_firsts(),
        "Variants": tx.join_safe(F.col("wordforms"), keep_empty=True),
        "Collocations": tx.join_safe(F.transform("fixed_expressions", lambda x: F.coalesce(x.expression, F.lit(""))), keep_empty=True),
        "Derivatives": tx.join_safe(F.coalesce(categories(F.col("orddannelser"), DERIVED), none), ", ", keep_empty=True),
        "Etymology": tx.ellipsis(F.col("etymology.raw"), always=True),
    }
    out = e.select("rank", position, *[F.coalesce(fields[f], F.lit("")).alias(f) for f in PLAIN_FIELDS], tx.guid(headword, pos).alias("guid"))
    return out.orderBy(F.col("rank").asc_nulls_last(), position).drop("rank", position)


def media(entries: DataFrame, audio: DataFrame, repeats: bool = False) -> DataFrame:
    """The files of mapped pronunciations, each once; with repeats, once for each pronunciation that uses it."""
    urls = entries.select(F.explode("udtale.audio").alias("url")).where("url is not null")
    if repeats:
        return urls.join(audio.groupBy("url").agg(F.min("path").alias("path")), "url").select("path")
    return audio.join(urls.distinct(), "url", "left_semi").select("path").distinct()
