"""Operators on small tables of their own: edge cases and files."""

from __future__ import annotations

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rostra.functions import references as R
from rostra.functions import text as T
from rostra.operators import agenda, chunks, identity, rollups, rules, scoring, sequence, state, topics
from rostra.sources import registry
from rostra.streaming import incremental


def values(spark, f, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r[1] for r in df.select("i", f(F.col("t"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("form", "text", "want"),
    [
        (T.speaker_key, "Doamna  Ștefan-Ion Ţepeş (din sală) - ministru, x", "stefan-ion tepes"), (T.analysis_text, " Straße ÎN  Țară ", "strasse in tara"), (T.export_text, "Straße", "straße"), (T.rules_key, " A  b ", "a  b"),
        (T.topic_words, "Legea 1/2020: «pensii»", "legea 1/2020 pensii"), (T.slug, " Ana—Maria! ", "ana-maria"), (T.slug, "!!", "unknown"), (T.law_form, "PL – x 12 / 2020", "PL-x 12/2020"), (T.analysis_text, None, ""),
        (T.cleaned_topic, "-3) buget,  taxe ;", "buget, taxe"), (T.word_count, "nu-i x_y d'A 12", 5), (T.letter_count, "a1²b_", 3), (T.plain_word_count, "Mulţumesc", 2), (T.sentence_count, "A. B! ... ", 2),
    ],
)
def test_text_forms(spark, form, text, want):
    assert values(spark, form, [text]) == [want]


def test_any_script_form():
    assert T.fold_any(pd.Series(["ﬁn  Straße", None])).tolist() == ["fin strasse", ""]


def test_cascade_falls_through_names_that_several_have(spark):
    members = spark.createDataFrame([("m1", "Pop Ion"), ("m2", "Pop Ion"), ("m3", "Rus Ana Maria"), ("m4", "Vlad Dan")], "member_id string, name string")
    said = spark.createDataFrame([("s", i, x) for i, x in enumerate(["Domnul Pop Ion", "Ana Maria Rus", "Maria, Ana Rus", "", None, "Dan Vlad"])], "session_id string, speech_index long, raw_speaker string")
    got = {r.speech_index: (r.resolved_id, r.resolved_by) for r in identity.resolve_speakers(said, members).collect()}
    assert got == {0: (None, None), 1: ("m3", "alias"), 2: ("m3", "token"), 3: (None, None), 4: (None, None), 5: ("m4", "alias")}
    assert identity.unmatched(identity.resolve_speakers(said, members)).count() == 1


def walked(rows, kind, mic, goes_on):
    out = []
    for c, row in enumerate(rows):
        parts, idx, found, at = [row[2]], [row[0]], None, c
        while at >= 2 and row[2] and rows[at - 2][1] == row[1]:
            k = kind(rows[at - 1][2])
            if k == "procedure_violation":
                found = k
                break
            if k is None or (k == "routine" and not (goes_on(parts[0]) or mic(rows[at - 2][2]) or mic(rows[at - 1][2]))):
                break
            parts.insert(0, rows[at - 2][2])
            idx.insert(0, rows[at - 2][0])
            found = "time_overrun" if k == "time_overrun" or found == "time_overrun" else "routine"
            at -= 2
        out.append((row[0], "\n\n".join(p for p in parts if p), idx, found))
    return out


def test_merge_against_a_walk(spark):
    r = random.Random(3)
    texts = ["a expirat timpul", "la subiect", "are cuvantul", "Ceva nou despre buget si taxe", "... si mai departe", "microfonul", ""]
    rows, all_ = [], {}
    for s in range(40):
        mine = [(i, r.choice("AB") if i % 2 == 0 else "chair", r.choice(texts)) for i in range(12)]
        all_[str(s)] = mine
        rows += [(str(s), *x) for x in mine]
    df = spark.createDataFrame(rows, "session_id string, speech_index long, raw_speaker string, text string")
    got = {}
    for x in sequence.merge_continuations(df).collect():
        got.setdefault(x.session_id, []).append((x.speech_index, x.merged_text, list(x.merged_indices), x.interruption_type))
    kind = lambda t: {"a expirat timpul": "time_overrun", "la subiect": "procedure_violation", "are cuvantul": "routine"}.get(t)
    for s, mine in all_.items():
        want = walked(mine, kind, lambda t: "microfonul" in t, lambda t: t.startswith("...") or t[:1].islower())
        assert sorted(got[s]) == sorted((i, t if rows_text(mine, i) else "", ix, f) for i, t, ix, f in want)


def rows_text(rows, i):
    return rows[i][2]


def test_packing(spark):
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate([5, 5, 5, 30, 1, 9, 1])], "session_id string, o long, n long")
    got = [(r.window, r.first, r.last, r.n, r.size) for r in chunks.packed(df, "session_id", "o", F.col("n"), 10).orderBy("window").collect()]
    assert got == [(0, 0, 1, 2, 10), (1, 2, 2, 1, 5), (2, 3, 3, 1, 30), (3, 4, 5, 2, 10), (4, 6, 6, 1, 1)]


def test_shortcuts_and_baseline(spark):
    said = ["Mulțumesc!", "Supun la vot proiectul.", "Domnul Ionescu.", "Da.", "Un discurs despre buget, taxe și oameni, lung", ""]
    assert values(spark, lambda c: rules.shortcut(c, F.lit(None).cast("string")), said) == ["greeting", "vote", "name_call", "short_reply", None, None]
    assert values(spark, lambda c: rules.shortcut(c, F.lit("procedure_violation")), said) == [None] * 6
    own = F.array(F.lit("t"))
    label = lambda c: rules.baseline(T.analysis_text(c), own, own)["label"]
    assert values(spark, label, ["scurt", "Propun un amendament la articolul doi al acestui proiect de lege", "Domnule, este o dictatura si o tradare, spun eu tuturor aici"]) == ["neutral", "constructive", "neutral"]


def test_references_and_agenda(spark):
    t = "Am depus amendamentul nr. 3 la PL-x 12/2020 și OUG nr. 5/2019."
    assert values(spark, R.first_law, [t, "nimic"]) == ["PL-x 12/2020", None]
    assert values(spark, lambda c: R.indexed_laws(c), ["nr. 7/2001", "lege, nr. 7/2001"]) == [[], ["nr. 7/2001"]]
    said = "Urmează Proiectul de Lege privind pensiile, PL-x 12/2020. Raportul comisiei."
    notes = spark.createDataFrame([("s", " ")], "session_id string, initial_notes string")
    rows = [("s", 0, said), ("s", 1, said), ("s", 2, said.replace("12", "13")), ("s", 3, "Proiectul de lege rămâne la votul final. " + said), ("s", 4, "Raport asupra: Propunerea legislativă pentru pensiile; dezbatere")]
    got = agenda.agenda(notes, spark.createDataFrame(rows, "session_id string, speech_index long, text string")).orderBy("item_number").collect()
    assert [(x.item_number, x.title, x.law_id) for x in got] == [(1, "Proiectul de Lege privind pensiile", "PL-x 12/2020"), (2, "Proiectul de Lege privind pensiile", "PL-x 13/2020"), (3, "Propunerea legislativă pentru pensiile", None)]


def test_productivity_shares_and_null_ratios(spark):
    rows = [("m1", "p", "constructive", "ab cd"), ("m1", "p", "neutral", "ab cd"), ("m1", "p", "non_constructive", "ab cd"), ("m2", None, "neutral", "!!"), (None, None, "constructive", "x")]
    got = {(r.level, r.member_id, r.party_id, r.is_member): r for r in rollups.productivity(spark.createDataFrame(rows, "member_id string, party_id string, label string, text string")).collect()}
    one = got["member", "m1", "p", None]
    assert (one.word_productivity_pct, one.counterproductiveness_pct, one.interventions) == (33.33, 33.33, 3)
    assert got["total", None, None, None].interventions == 5 and ("population", None, None, False) in got and ("member", "m2", None, None) not in got


def test_state(spark):
    old = spark.createDataFrame([(1, "base", 1), (2, "model", 1)], "k long, source string, v long")
    new = spark.createDataFrame([(1, "base", 2), (2, "base", 2), (3, "base", 2)], "k long, source string, v long")
    as_set = lambda df: {tuple(r) for r in df.collect()}
    assert as_set(state.upsert(old, new, ["k"])) == as_set(new)
    assert as_set(state.guarded_upsert(old, new, ["k"], "source", "base")) == {(1, "base", 2), (2, "model", 1), (3, "base", 2)}
    assert as_set(state.insert_new(old, new, ["k"])) == {(1, "base", 1), (2, "model", 1), (3, "base", 2)}
    assert state.changed_rows(new, new, ["k"]).count() == 0


def test_model_answers(spark):
    assert scoring.unwrapped('```json\n{"data": "{\\"results\\": [1]}"}\n```') == "[1]" and scoring.unwrapped("nothing") is None and scoring.unwrapped(None) is None
    assert scoring.unwrapped('{"speech_index": 1, "qa_action": "x"}') == '[{"speech_index": 1, "qa_action": "x"}]'
    rows = spark.createDataFrame([("s", 0, "x" * 10), ("s", 1, "y" * 900)], "session_id string, speech_index long, text string")
    got = {r.speech_index: json.loads(r.answer)["results"][0]["constructiveness_label"] for r in scoring.scored(rows, "text").collect()}
    assert got == {0: "neutral", 1: "constructive"}

    def broken():
        def score(prompts):
            raise OSError("no answer")

        return score

    assert {r.answer for r in scoring.scored(rows, "text", broken).collect()} == {None}


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"metadata": {}, "members": [{"name": "Pop Ion", "profile_url": "https://x/p?ParlamentarID=7", "party": "P", "bills_authored": "x", "total_bills_authored": "4"}, {"name": " "}]}))
    m = registry.read_registry(spark, str(tmp_path / "m.json"), "senator").collect()
    assert [(x.member_id, x.bills_authored_total, x.amendments_added_total) for x in m] == [("senator_7", 4, 0)]
    (tmp_path / "s.json").write_text(json.dumps({"session_id": "s1", "stenograma_date": "2024-01-02", "speeches": [{"speaker": "A", "text": " x ", "text2": None, "text3": "y"}, {"speaker": "B"}]}))
    s = registry.read_sessions(spark, str(tmp_path / "s.json")).orderBy("speech_index").collect()
    assert [(x.speech_index, x.raw_speaker, x.text, str(x.session_date)) for x in s] == [(0, "A", "x y", "2024-01-02"), (1, "B", "", "2024-01-02")]
    (tmp_path / "ids.txt").write_text("b\n\na\nb\n")
    assert [x.id for x in registry.read_ids(spark, str(tmp_path / "ids.txt")).orderBy("position").collect()] == ["b", "a"]
    (tmp_path / "t.json").write_text(json.dumps({"topic_stopwords": [], "token_equivalents": {"Taxa": "taxe"}, "direction_rules": [{"label": "Economie", "mapped_tokens": ["taxe"], "raw_roots": ["fiscal"]}], "catalog_topics": [{"id": "c", "label": "Economie", "description": "", "aliases": ["Bani"]}]}))
    t = topics.read_taxonomy(spark, str(tmp_path / "t.json"))
    assert sorted(x.keyword for x in topics.keywords(t).collect()) == ["bani", "economie", "fiscal", "taxa", "taxe"]
    assert [x.id for x in topics.catalog(t.withColumn("catalog_topics", F.lit(None).cast(t.schema["catalog_topics"].dataType))).collect()] == ["dir_01"]


def test_files_are_processed_once(spark, tmp_path):
    folder, ledger, seen = tmp_path / "in", tmp_path / "ledger", []
    folder.mkdir()
    handle = lambda files, n: seen.append(sorted((r.path.rsplit("/", 1)[1], r.reason) for r in files.collect()))
    run = lambda: incremental.process_new(spark, str(folder), str(ledger), str(tmp_path / "c"), handle).awaitTermination()
    (folder / "a.json").write_text("1")
    (folder / "b.json").write_text("2")
    run()
    run()
    (folder / "c.json").write_text("3")
    run()
    assert seen == [[("a.json", "new"), ("b.json", "new")], [("c.json", "new")]]
    assert incremental.read_ledger(spark, str(ledger)).count() == 3


def test_state_tables_are_made_once_and_grow_columns(spark, tmp_path):
    from rostra.sources import tables

    assert set(tables.create_tables(spark, str(tmp_path))) == set(tables.STATE) and tables.create_tables(spark, str(tmp_path)) == []
    spark.createDataFrame([("r1", "s", "p", "a", 3.0)], "run_id string, session_id string, stenogram_path string, raw_speaker string, extra double").write.mode("append").parquet(f"{tmp_path}/unmatched_speakers")
    [row] = tables.read_table(spark, str(tmp_path), "unmatched_speakers").collect()
    assert row.occurrences == 1 and row.normalized_speaker is None and "extra" not in row


def test_an_index_is_made_anew_only_where_chunks_changed(spark, tmp_path):
    from rostra.sources import tables

    shape = "session_id string, chunk_index long, chunk_id string, chunk_type string, source_speech_index long, text string"
    rows = [("1", 0, "ch:1:0", "speech", 0, "first words"), ("2", 0, "ch:2:0", "speech", 0, "second words")]
    assert tables.read_index(spark, str(tmp_path / "none")) is None
    tables.write_index(tables.updated_index(spark.createDataFrame(rows, shape), None), str(tmp_path / "a"))
    old = tables.read_index(spark, str(tmp_path / "a"))
    rows[1] = ("2", 0, "ch:2:0", "speech", 0, "changed words")
    marked = lambda text: [9.0]
    got = {r.session_id: r for r in tables.updated_index(spark.createDataFrame(rows, shape), old, marked).collect()}
    assert len(got["1"].embedding) == 64 and got["2"].embedding == [9.0] and got["2"].text == "changed words" and len(got) == 2


def test_prompts_that_fail_leave_their_neighbours_alone(spark):
    from rostra.operators import scoring

    def factory():
        tries = {}

        def score(prompts):
            for p in prompts:
                tries[p] = tries.get(p, 0) + 1
            if "bad" in prompts or ("slow" in prompts and tries["slow"] < 3):
                raise ValueError("no")
            return ["{}" if p.startswith(scoring.MEND) else "{" if p == "torn" else p.upper() for p in prompts]

        return score

    rows = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "bad", "slow", None, "torn", "b"])], "i int, p string").coalesce(1)
    got = {r.p: r.answer for r in scoring.scored(rows, "p", factory, readable=lambda a: a != "{").collect()}
    assert got == {"a": "A", "bad": None, "slow": "SLOW", None: None, "torn": "{}", "b": "B"}


def test_classify_takes_the_architecture_of_the_model(spark):
    import json

    from rostra.operators import orchestration

    rows = [("1", i, "A", "word " * 30, None, [], ["t"]) for i in range(3)]
    s = spark.createDataFrame(rows, "session_id string, speech_index long, raw_speaker string, text string, interruption string, chairs array<string>, session_topics array<string>")
    answer = json.dumps([{"speech_index": 1, "constructiveness_label": "constructive", "confidence": 0.8, "topics": ["t", "T"]}])
    got = orchestration.classify(s, s.where("speech_index = 0"), "gpt", "openai", {"model": lambda: lambda ps: [answer for _ in ps]}).collect()
    assert {r.speech_index for r in got} == {1, 2} and {r.architecture for r in got} == {"one_pass"}
    assert next(r for r in got if r.speech_index == 1).topics == ["t"] and all(r.label == "constructive" for r in got)


def test_similar_scores_what_can_be_found_and_nothing_else(spark):
    # Nulls, NaN, infinities, a null and a zero vector, equal and nearly equal vectors, other lengths, repeated rows and ids.
    rng = random.Random(7)
    near = [rng.gauss(0, 1) for _ in range(70)]
    rows = [("a", i, [rng.gauss(0, 1) for _ in range(70)]) for i in range(300)]
    rows += [("a", 300 + i, [x + rng.gauss(0, 1e-6) for x in near]) for i in range(20)] + [("a", 320 + i, near) for i in range(20)]
    rows += [("a", 340, [0.0] * 70), ("a", 341, None), ("a", 342, [float("nan")] * 70), ("a", 343, [float("inf")] + near[1:]), ("a", 344, [None, *near[1:]]), ("a", 345, near[:3]), ("a", 346, [1e300] * 70)]
    rows += [rows[0], rows[0], ("a", 1, near), ("a", None, near), (None, 5, near), ("b", 1, [1.0]), ("b", 2, [2.0]), ("b", 3, None), ("c", 1, near)]
    e = spark.createDataFrame(rows, "session_id string, id long, embedding array<double>").cache()
    pairs = e.join(e.select("session_id", F.col("id").alias("chunk"), F.col("embedding").alias("other")), "session_id").where("id <> chunk")
    pairs.select("session_id", "id", "chunk", chunks.dot(F.col("embedding"), F.col("other")).alias("score")).createOrReplaceTempView("pairs_of_vectors")
    ranked = spark.sql("select *, row_number() over (partition by session_id, id order by score desc, chunk) as rank from pairs_of_vectors").where("rank <= 5")
    text = lambda df: sorted(repr(tuple(r[c] for c in ("session_id", "id", "rank", "chunk", "score"))) for r in df.collect())
    want = text(ranked)
    assert text(chunks.similar(e, e, 5, 16)) == want and text(chunks.similar(e, e, 5)) == want
    plain = e.where("session_id = 'a' and id < 300").select("session_id", "id", F.slice("embedding", 1, 64).alias("embedding")).distinct()
    left = chunks.reaching(plain.where("id > 1"), plain.select("session_id", F.col("id").alias("chunk"), F.col("embedding").alias("other")), 5, 64)
    assert 298 * 5 <= left.count() < 298 * 30  # of 298 * 300 pairs
