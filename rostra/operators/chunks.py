"""Session chunks, retrieval from them, and packing into windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.functions.text import analysis_text, retrieval_tokens, stripped


def build_chunks(speeches: DataFrame, notes: DataFrame, least: int = 80) -> DataFrame:
    """Notes that aren't blank, then the speeches whose normal form has `least` characters; dense chunk_index in a session."""
    n = notes.where(stripped(F.col("initial_notes")) != "").select("session_id", F.lit("session_notes").alias("chunk_type"), F.lit(None).cast("long").alias("source_speech_index"), stripped(F.col("initial_notes")).alias("text"))
    s = speeches.where(F.length(analysis_text(F.col("text"))) >= least).select("session_id", F.lit("speech").alias("chunk_type"), F.col("speech_index").alias("source_speech_index"), "text")
    order = Window.partitionBy("session_id").orderBy(F.col("source_speech_index").asc_nulls_first())
    return n.unionByName(s).withColumn("chunk_index", (F.row_number().over(order) - 1).cast("long")).withColumn("chunk_id", F.concat(F.lit("ch:"), "session_id", F.lit(":"), "chunk_index")).withColumn("tokens", retrieval_tokens(F.col("text")))


def substantive(chunks: DataFrame, least: int = 200, enough: int = 5) -> DataFrame:
    """Speech chunks of `least` characters; all speech chunks of a session with fewer than `enough` of those."""
    long_ = F.length("text") >= least
    w = Window.partitionBy("session_id")
    return chunks.where("chunk_type = 'speech'").withColumn("n", F.count_if(long_).over(w)).where(long_ | (F.col("n") < enough)).drop("n")


def index_hash(chunks: DataFrame) -> DataFrame:
    """A session's content hash; an index is rebuilt only where it differs."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", F.concat("chunk_id", "text").alias("c"))))
    return chunks.groupBy("session_id").agg(F.substring(F.sha2(F.array_join(F.transform(ordered, lambda x: x["c"]), ""), 256), 1, 16).alias("content_hash"), F.count("*").alias("chunks"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def neighbours(speeches: DataFrame, chunks: DataFrame, reach: int = 3) -> DataFrame:
    """For each speech the chunks up to `reach` places from the one nearest to it, that one included.

    The nearest comes from two running windows over speeches and chunks together, not from pairs; the join on
    places is an equality of session and place.
    """
    c = chunks.where("chunk_type = 'speech'").select("session_id", F.col("source_speech_index").alias("at"), "chunk_id")
    placed = c.withColumn("place", F.row_number().over(Window.partitionBy("session_id").orderBy("at")))
    # A chunk comes before a speech of the same index when one looks back.
    both = placed.select("session_id", "at", "place", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("speech_index")).unionByName(
        speeches.select("session_id", F.col("speech_index").alias("at"), F.lit(None).cast("int").alias("place"), F.lit(1).alias("kind"), "speech_index")
    )
    at = F.when(F.col("kind") == 0, F.struct("at", "place"))
    order = Window.partitionBy("session_id").orderBy("at", "kind")
    before = F.last(at, True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(at, True).over(order.rowsBetween(0, Window.unboundedFollowing))
    near = both.withColumn("b", before).withColumn("a", after).where("kind = 1")
    place = F.when(F.col("b").isNull(), F.col("a.place")).when(F.col("a").isNull(), F.col("b.place")).when(F.col("at") - F.col("b.at") <= F.col("a.at") - F.col("at"), F.col("b.place")).otherwise(F.col("a.place"))
    wanted = near.withColumn("nearest", place).where("nearest is not null").select("session_id", "speech_index", "nearest", F.explode(F.sequence(F.col("nearest") - reach, F.col("nearest") + reach)).alias("place"))
    return wanted.join(placed, ["session_id", "place"]).select("session_id", "speech_index", "nearest", "place", "chunk_id")


#: The first look at a vector: so many words of two components each, in whole steps of a 63rd of its largest one. Words are
#: doubles x + y * 2^18; the sum of 16 products of words keeps its three sums apart and is exact.
_WORDS, _STEPS, _SHIFT = 32, 63, 2.0**18


def _sketched(rows: DataFrame, vector: str, start: str, turned: bool) -> DataFrame:
    """rows with the words of `vector` in its place (the two components change places where `turned`), and what bounds the rest.

    unit: what a step is; norm: the length of what the words tell, or where `turned` of the whole; off: the length of what
    they don't tell; size: negative, and all else 0, if the vector has nulls, NaN, infinities or lengths that can't be squared.
    """
    e = F.col(vector).cast("array<double>")
    length = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, y: s + y * y))
    v = rows.withColumn("largest", F.greatest(F.array_max(e), -F.array_min(e)))
    ordinary = (F.size(vector) == 0) | (F.col("largest") == 0) | F.col("largest").between(1e-100, 1e100)
    v = v.withColumn("plain", F.coalesce(F.forall(vector, F.isnotnull) & ordinary, F.lit(False))).withColumn("e", F.when(F.col("plain"), e).otherwise(F.array().cast("array<double>")))
    v = v.withColumn("unit", F.when(F.col("plain"), F.coalesce(F.col("largest") / _STEPS, F.lit(0.0))).otherwise(0.0)).withColumn("each", F.when(F.col("unit") > 0, F.try_divide(F.lit(1.0), F.col("unit"))).otherwise(0.0))
    v = v.withColumn("k", F.transform(F.slice("e", 1, 2 * _WORDS), lambda x: F.rint(x * F.col("each"))))
    rest = F.zip_with("e", "k", lambda x, k: x - F.coalesce(k, F.lit(0.0)) * F.col("unit"))
    v = v.withColumn("whole", length(F.col("e"))).withColumn("off", length(rest) + F.col("whole") * 1e-9)
    at = lambda i: F.coalesce(F.get("k", F.lit(i)), F.lit(0.0))
    words = {f"w{j}": at(2 * j + turned) + at(2 * j + 1 - turned) * _SHIFT for j in range(_WORDS)}
    norm = F.col("whole") if turned else F.col("whole") * (1 + 1e-9) + F.col("off")
    size = F.when(F.col("plain"), F.size("e")).otherwise(-2 if turned else -1)
    kept = {"size": size, "unit": F.coalesce("unit", F.lit(0.0)), "norm": F.coalesce(norm, F.lit(0.0)), "off": F.coalesce("off", F.lit(0.0))} | words
    return v.select(*[c for c in rows.columns if c != vector], *[x.alias(start + n) for n, x in kept.items()])


def _looked() -> tuple[Column, Column]:
    """The dot product of what the words q_ and c_ tell, and how far that of the vectors can be from it."""
    total = F.lit(0.0)
    for j in range(0, _WORDS, 16):
        s = F.lit(_SHIFT / 2)
        for i in range(j, j + 16):
            s = s + F.col(f"q_w{i}") * F.col(f"c_w{i}")
        total = total + F.shiftright(F.shiftleft(s.cast("long"), 28), 46).cast("double")
    return total * F.col("q_unit") * F.col("c_unit"), F.col("q_off") * F.col("c_norm") + F.col("q_norm") * F.col("c_off")


def reaching(asked: DataFrame, held: DataFrame, top: int = 5, block: int = 1024) -> DataFrame:
    """session_id, id, chunk of the pairs that can be among a query's `top`; asked has `id` and `embedding`, held `chunk` and `other`.

    Some `block` chunks of a session tell a bar that `top` of them reach for sure, by a look at short words. Then every
    pair is looked at: what can't reach the bar, or what `top` of those left reach for sure, goes. A session's queries
    are dealt out in blocks.
    """
    key = ["session_id", "block"]
    n = asked.groupBy("session_id").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    q = asked.join(n, "session_id").select("session_id", "id", "embedding", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    q = _sketched(q, "embedding", "q_", False)
    c = _sketched(held.join(n, "session_id").select("session_id", "chunk", "other", "blocks"), "other", "c_", True)
    c = c.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(2 * top)).cast("int")).withColumn("told", F.pmod(F.xxhash64("chunk", F.lit(1)), F.col("blocks")) == 0)
    c = c.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    near, off = _looked()
    least = c.where("told").join(q, key).where("id <> chunk and q_size = c_size").groupBy(*key, "id", "group").agg(F.max(near - off).alias("least"))
    bar = least.groupBy(*key, "id").agg(F.get(F.sort_array(F.collect_list("least"), False), F.lit(top - 1)).alias("bar"))
    barred = q.join(bar, [*key, "id"], "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
    odd = (F.col("q_size") < 0) | (F.col("c_size") < 0)
    reach = c.join(barred, key).where("id <> chunk").where(odd | (near + off >= F.col("bar")))
    reach = reach.select(*key, "id", "chunk", odd.alias("odd"), (F.col("q_size") == F.col("c_size")).alias("alike"), near.alias("near"), off.alias("off"))
    sure = F.when(F.col("alike"), F.col("near") - F.col("off"))
    by = Window.partitionBy(*key, "id").orderBy(F.desc_nulls_last("sure")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = reach.withColumn("sure", sure).withColumn("last", F.nth_value("sure", top).over(by))
    return last.where(F.col("odd") | F.col("last").isNull() | (F.col("near") + F.col("off") >= F.col("last"))).select("session_id", "id", "chunk").distinct()


def similar(queries: DataFrame, chunks: DataFrame, top: int = 5, block: int = 1024) -> DataFrame:
    """C11: the chunks of the highest dot product in the query's session, other than itself; ties by id.

    queries and chunks: session_id, id, embedding. Sessions bound the candidates; only those that can be found are
    scored. Of equal vectors only the first top + 1 ids can be.
    """
    row = ["session_id", "id", "embedding"]
    asked = queries.where("id is not null").groupBy(*row).agg(F.count("*").alias("q_times"))
    held = chunks.where("id is not null").groupBy(*row).agg(F.count("*").alias("c_times"))
    first = Window.partitionBy("session_id", "embedding").orderBy("id")
    held = held.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= top + 1).select("session_id", F.col("id").alias("chunk"), F.col("embedding").alias("other"), "c_times")
    found = reaching(asked, held, top, block).join(asked, ["session_id", "id"]).join(held, ["session_id", "chunk"])
    scored = found.select("session_id", "id", "chunk", dot(F.col("embedding"), F.col("other")).alias("score"), F.least(F.col("q_times") * F.col("c_times"), F.lit(top)).cast("int").alias("times"))
    w = Window.partitionBy("session_id", "id").orderBy(F.desc("score"), "chunk")
    each = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("session_id", "id", "chunk", "score", "rank")


def evidence(speeches: DataFrame, chunks: DataFrame, top: int = 3) -> DataFrame:
    """The chunks of a speech's session with the highest Jaccard of tokens, above 0; else the session's first chunk."""
    q = speeches.select("session_id", "speech_index", F.array_distinct(retrieval_tokens(F.col("text"))).alias("q"))
    scored = q.join(chunks.select("session_id", "chunk_id", "chunk_index", F.array_distinct("tokens").alias("t")), "session_id").withColumn("score", F.coalesce(jaccard(F.col("q"), F.col("t")), F.lit(0.0)))
    w = Window.partitionBy("session_id", "speech_index")
    ranked = scored.withColumn("best", F.max("score").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), "chunk_id"))).withColumn("nth", F.row_number().over(w.orderBy("chunk_index")))
    keep = ((F.col("score") > 0) & (F.col("rank") <= top)) | ((F.col("best") == 0) & (F.col("nth") == 1))
    return ranked.where(keep).select("session_id", "speech_index", "chunk_id", F.when(F.col("best") == 0, 1).otherwise(F.col("rank")).alias("rank"), F.round("score", 6).alias("score"))


def hybrid(speeches: DataFrame, chunks: DataFrame, top: int = 10, reach: int = 3) -> DataFrame:
    """A session's notes, the neighbours, then the most similar by Jaccard, each chunk once, `top` in all; pinned ones score 1.

    Notes and neighbours come first, in this order; S4: listed by pinned, score and id as text.
    """
    keys = ["session_id", "speech_index"]
    notes = speeches.select(*keys).join(chunks.where("chunk_type = 'session_notes'").select("session_id", "chunk_id"), "session_id").select(*keys, "chunk_id", F.lit(0).alias("tier"), F.lit(1.0).alias("score"), F.lit(0).alias("place"))
    near = neighbours(speeches, chunks, reach).select(*keys, "chunk_id", F.lit(1).alias("tier"), F.lit(1.0).alias("score"), "place")
    q = speeches.select(*keys, F.array_distinct(retrieval_tokens(F.col("text"))).alias("q"))
    alike = q.join(chunks.select("session_id", "chunk_id", F.array_distinct("tokens").alias("t")), "session_id").select(*keys, "chunk_id", F.lit(2).alias("tier"), F.round(F.coalesce(jaccard(F.col("q"), F.col("t")), F.lit(0.0)), 6).alias("score"), F.lit(0).alias("place"))
    first = Window.partitionBy(*keys, "chunk_id").orderBy("tier")
    rank = Window.partitionBy(*keys).orderBy("tier", F.desc("score"), "place", "chunk_id")
    listed = Window.partitionBy(*keys).orderBy((F.col("tier") > 1), F.desc("score"), "chunk_id")
    reason = F.element_at(F.array(F.lit("session_notes"), F.lit("neighbor"), F.lit("similarity")), F.col("tier") + 1)
    one = notes.unionByName(near).unionByName(alike).withColumn("nth", F.row_number().over(first)).where("nth = 1").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
    return one.select(*keys, "chunk_id", "score", reason.alias("reason"), F.row_number().over(listed).alias("position"))


def packed(rows: DataFrame, group: str, order: str, size: Column, most: int) -> DataFrame:
    """Group, window, first, last, n and size of windows that are filled in order until the next would exceed `most`.

    One too large alone is a window of its own. The fold runs over the ordered sizes of a group, in one expression.
    """
    start = F.lit(None).cast("array<struct<first:bigint,last:bigint,n:bigint,size:bigint>>")
    items = F.array_sort(F.collect_list(F.struct(F.col(order).cast("long").alias("o"), size.cast("long").alias("s"))))

    def step(acc, x):
        end = F.element_at(acc, -1)
        fresh = F.array(F.struct(x["o"].alias("first"), x["o"].alias("last"), F.lit(1).cast("long").alias("n"), x["s"].alias("size")))
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(end["first"].alias("first"), x["o"].alias("last"), (end["n"] + 1).alias("n"), (end["size"] + x["s"]).alias("size"))))
        return F.when(acc.isNull(), fresh).when(end["size"] + x["s"] > most, F.concat(acc, fresh)).otherwise(grown)

    return rows.groupBy(group).agg(items.alias("items")).select(group, F.posexplode(F.aggregate("items", start, step)).alias("window", "w")).select(group, "window", "w.*")


def inspected(found: DataFrame, chunks: DataFrame, preview: int = 160) -> DataFrame:
    """What retrieval found (session_id, speech_index, position, chunk_id, reason, score), each with its kind, length and beginning."""
    short = F.when(F.length("text") > preview, F.concat(F.left("text", F.lit(preview)), F.lit("…"))).otherwise(F.col("text"))
    own = chunks.select("session_id", "chunk_id", "chunk_type", F.length("text").cast("long").alias("chars"), short.alias("preview"))
    return found.join(own, ["session_id", "chunk_id"]).select("session_id", "speech_index", "position", "chunk_id", "reason", "score", "chunk_type", "chars", "preview")
