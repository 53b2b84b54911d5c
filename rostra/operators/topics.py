"""Topics: taxonomies, matching, canonical names, and their counts by session, member and party."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostra.functions.references import first_law, law_topic, references
from rostra.functions.text import analysis_text, export_text, holds_any, let, mapped_tokens, overlap_text, overlap_tokens, topic_words, variants

#: The name of what fits no direction, and the direction of whatever names a law.
OTHER, LEGISLATIVE = "altele", "proces legislativ si reforme"
TAXONOMY = "topic_stopwords array<string>, token_equivalents map<string,string>, direction_rules array<struct<label:string,mapped_tokens:array<string>,raw_roots:array<string>>>, catalog_topics array<struct<id:string,label:string,description:string,aliases:array<string>>>"


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """One row with the four parts, typed; parts that are missing are null."""
    return spark.read.schema(TAXONOMY).json(path, multiLine=True)


def keywords(taxonomy: DataFrame) -> DataFrame:
    """Rank, topic, keyword: label, aliases, roots and mapped tokens of the rule of that label, and the terms mapped to one of those."""
    t = taxonomy.select("*", F.posexplode("catalog_topics").alias("rank", "c"))
    t = t.withColumn("rule", F.try_element_at(F.filter("direction_rules", lambda r: r["label"] == F.col("c.label")), F.lit(-1)))
    none = F.array().cast("array<string>")
    mapped = F.coalesce("rule.mapped_tokens", none)
    normal = F.transform(mapped, analysis_text)
    terms = F.transform(F.filter(F.map_entries("token_equivalents"), lambda e: F.array_contains(normal, analysis_text(e["value"]))), lambda e: e["key"])
    words = F.concat(F.array("c.label"), F.coalesce("c.aliases", none), F.coalesce("rule.raw_roots", none), mapped, F.coalesce(terms, none))
    return t.select("rank", F.col("c.label").alias("topic"), F.explode(F.array_distinct(F.filter(F.transform(words, analysis_text), lambda w: w != ""))).alias("keyword"))


def catalog(taxonomy: DataFrame) -> DataFrame:
    """Id, label, description, aliases; the labels of the rules as dir_NN if there is no catalog."""
    rules = F.transform("direction_rules", lambda r, i: F.struct(F.format_string("dir_%02d", i + 1).alias("id"), r["label"].alias("label"), F.lit("").alias("description"), F.array().cast("array<string>").alias("aliases")))
    return taxonomy.select(F.inline(F.when(F.coalesce(F.size("catalog_topics"), F.lit(0)) > 0, F.col("catalog_topics")).otherwise(rules)))


def keyword_met(key: Column, word: str) -> Column:
    """Of several words anywhere; of four letters at most as a whole token; else as a token's beginning."""
    if " " in word:
        return F.contains(key, F.lit(word))
    return key.rlike(rf"(?<![a-z0-9])\Q{word}\E" + (r"(?![a-z0-9])" if len(word) <= 4 else ""))


def topics_of(text: Column, taxonomy: Sequence[tuple[str, Sequence[str]]], most: int = 5) -> Column:
    """references, then the topics of the taxonomy in its order, `most` in all."""

    def found(key: Column) -> Column:
        met = []
        for topic, words in taxonomy:
            any_ = F.lit(False)
            for w in words:
                any_ = any_ | keyword_met(key, w)
            met.append(F.when(any_, F.lit(topic)))
        return F.slice(F.array_distinct(F.concat(references(key, most), F.array_compact(F.array(*met)))), 1, most)

    return let(analysis_text(text), found)


def session_topics(speeches: DataFrame, notes: DataFrame, taxonomy: Sequence[tuple[str, Sequence[str]]], below: int = 30, least: int = 160, top: int = 20) -> DataFrame:
    """The topics of a session by weight: 4 from the notes (of 12), 2.5 from each early long speech, 0.1 a time.

    Laws come first, then the higher score, then the later name.
    """
    n = notes.select("session_id", F.explode(topics_of(F.col("initial_notes"), taxonomy, 12)).alias("topic"), F.lit(4.1).alias("score"))
    long_ = speeches.where((F.col("speech_index") < below) & (F.length(analysis_text(F.col("text"))) >= least))
    s = long_.select("session_id", F.explode(topics_of(F.col("text"), taxonomy)).alias("topic"), F.lit(2.6).alias("score"))
    total = n.unionByName(s).groupBy("session_id", "topic").agg(F.round(F.sum("score"), 6).alias("score"))
    w = Window.partitionBy("session_id").orderBy(law_topic(F.col("topic")).desc(), F.desc("score"), F.desc("topic"))
    return total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def topic_key(topic: Column, equivalents: dict[str, str], stopwords: Sequence[str]) -> Column:
    """By law, else by the first six sorted tokens, else by the text."""
    tokens = F.slice(F.array_sort(F.array_distinct(mapped_tokens(topic, equivalents, stopwords))), 1, 6)
    by_tokens = let(tokens, lambda t: F.when(F.size(t) > 0, F.concat(F.lit("kw:"), F.array_join(t, "|"))))
    return let(F.concat(F.lit("law:"), F.lower(first_law(topic))), lambda law: F.coalesce(law, by_tokens, F.concat(F.lit("raw:"), export_text(topic))))


def direction(topic: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]], equivalents: dict[str, str], stopwords: Sequence[str]) -> Column:
    """the first rule of which a token or root is met."""

    def ruled(of: Column) -> Column:
        out = F.when(of["law"], LEGISLATIVE)
        for label, mapped, roots in rules:
            out = out.when(F.arrays_overlap(of["tokens"], F.array(*map(F.lit, mapped)).cast("array<string>")) | holds_any(of["key"], roots), label)
        return out.otherwise(OTHER)

    return let(F.struct(export_text(topic).alias("key"), mapped_tokens(topic, equivalents, stopwords).alias("tokens"), first_law(topic).isNotNull().alias("law")), ruled)


def canonical(topics: DataFrame, key: Column) -> DataFrame:
    """Key, canonical, count, aliases: the most frequent alias of each key (ties: by lower case, then as is); laws in capitals."""
    a = topics.select(key.alias("key"), F.trim("topic").alias("alias")).where("alias <> ''").groupBy("key", "alias").agg(F.count("*").alias("n"))
    by = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.lower("alias").alias("l"), "alias")))
    g = a.groupBy("key").agg(by.alias("by"), F.sum("n").alias("count"))
    law = F.replace(F.upper(F.substring("key", 5, 1000)), F.lit("NR."), F.lit("nr."))
    return g.select("key", F.when(F.col("key").startswith("law:"), law).otherwise(F.col("by")[0]["alias"]).alias("canonical"), "count", F.slice(F.transform("by", lambda x: x["alias"]), 1, 8).alias("aliases"))


def top_names(counted: DataFrame, group: Sequence[str], name: str = "topic", top: int = 20) -> DataFrame:
    """The names of each group by count, then name."""
    c = counted.groupBy(*group, name).agg(F.count("*").alias("count"))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("count"), name))).where(F.col("rank") <= top)


def top_directions(counted: DataFrame, group: Sequence[str], top: int = 20) -> DataFrame:
    """Directions, and beside them how often none fits."""
    rest = counted.groupBy(*group).agg(F.count_if(F.col("direction") == OTHER).alias("other_topics_count"))
    return top_names(counted.where(F.col("direction") != OTHER), group, "direction", top).join(rest, [*group])


def _overlap(words: Column) -> Column:
    kept = F.filter(F.split(words, " "), lambda w: F.length(w) >= 3)
    return F.array_distinct(F.filter(F.flatten(F.transform(kept, variants)), lambda v: F.length(v) >= 3))


def snap(topics: DataFrame, session_labels: DataFrame) -> DataFrame:
    """C14: topics (session_id, id, topic) with the label of the session that is the same, else contains it or is contained, else shares most tokens.

    Labels come in `position` order; containment needs six letters, tokens half and two in common. The forms of
    topics and labels are made before they meet, and each different topic of a session is judged once. Equal ones
    meet by a hash join; only topics without an equal label are compared with the labels of their session.
    """
    forms = lambda rows, c: rows.withColumn("key", topic_words(F.col(c))).withColumn("tokens", _overlap(F.col("key")))
    label = forms(session_labels.select("session_id", "label", "position"), "label").select("session_id", "label", "position", F.col("key").alias("label_key"), F.col("tokens").alias("label_tokens"))
    keyed = topics.withColumn("key", topic_words(F.col("topic")))
    each = keyed.where("key <> ''").select("session_id", "key").distinct()
    equal = label.groupBy("session_id", F.col("label_key").alias("key")).agg(F.min_by("label", "position").alias("same"))
    each = each.join(equal, ["session_id", "key"], "left")
    open_ = each.where("same is null").select("session_id", "key", _overlap(F.col("key")).alias("tokens")).join(label, "session_id")
    inside = (F.length("key") >= 6) & (F.contains("label_key", F.col("key")) | F.contains("key", F.col("label_key")))
    common = F.size(F.array_intersect("tokens", "label_tokens"))
    score = F.try_divide(common, F.greatest(F.size("tokens"), F.size("label_tokens")))
    near = open_.select("session_id", "key", "label", "position", inside.alias("inside"), common.alias("common"), score.alias("score")).where("inside or (score >= 0.5 and common >= 2)")
    best = F.struct(~F.col("inside"), F.when(F.col("inside"), 0.0).otherwise(-F.col("score")), "position")
    chosen = near.groupBy("session_id", "key").agg(F.min_by("label", best).alias("other"))
    named = each.join(chosen, ["session_id", "key"], "left").select("session_id", "key", F.coalesce("same", "other").alias("snapped"))
    return keyed.join(named, ["session_id", "key"], "left").select("session_id", "id", "topic", F.coalesce("snapped", "topic").alias("snapped"))


def active_thread(speeches: DataFrame, candidates: DataFrame, stopwords: Sequence[str] = (), top: int = 3, recent: int = 3) -> DataFrame:
    """C17: the topics and agenda items (session_id, source, label, detail) that a speech and the three before it speak of.

    One point for each shared token, two if the label occurs as it is.
    """
    w = Window.partitionBy("session_id").orderBy("speech_index").rowsBetween(-recent, 0)
    s = speeches.select("session_id", "speech_index", F.array_join(F.collect_list("text").over(w), " ").alias("said"))
    s = s.withColumn("norm", overlap_text(F.col("said"))).withColumn("tokens", overlap_tokens(F.col("said"), stopwords))
    c = candidates.select("session_id", "source", "label", overlap_tokens(F.col("detail"), stopwords).alias("own"), overlap_text(F.col("label")).alias("verbatim")).where(F.size("own") > 0)
    score = F.size(F.array_intersect("tokens", "own")) + F.when((F.col("verbatim") != "") & F.contains("norm", F.col("verbatim")), 2).otherwise(0)
    order = Window.partitionBy("session_id", "speech_index").orderBy(F.desc("score"), "source", "label")
    return s.where(F.size("tokens") > 0).join(c, "session_id").withColumn("score", score).where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("session_id", "speech_index", "source", "label", "score", "rank")
