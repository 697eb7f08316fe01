"""Queries over conversations, texts and results, with their SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.labels import merge_labels
from ..generation.model import EchoClient
from ..generation.process import Settings, run
from ..generation.prompts import DISTRIBUTIONS
from ..operators import catalog, results
from ..session import shared_dir, table
from ..sources.adapters import explained_answer
from ..sources.records import in_order, majority, pad
from ..streaming import result_stream


def _chats(spark: SparkSession, d: str) -> DataFrame:
    """One row per export."""
    return table(spark, d, "chat_exports").where("export_id is not null").dropDuplicates(["export_id"])


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Exported chats as results: the export's number stands for the attempt."""
    rows = _chats(spark, d).select(F.col("image").alias("image_path"), F.col("export_id").alias("attempt"), F.lit(0).alias("step"), "prompt_type", F.array().cast("array<string>").alias("input"), F.col("conversations.value").alias("output"), "run_id")
    return rows.withColumn("filtered_out", F.lit(None).cast("array<string>"))


def conversation_export(spark: SparkSession, d: str) -> DataFrame:
    """Messages of every export with the role of their place, the picture's mark first."""
    rows = _results(spark, d).select("attempt", F.posexplode(results.conversation(F.col("output"))).alias("turn", "m"))
    return rows.select(F.col("attempt").alias("export_id"), "turn", F.col("m.from").alias("role"), F.col("m.value").alias("value"))


def first_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Exports of the first attempts, other prompt types than two, of known pictures."""
    listing = table(spark, d, "annotations").select("image_path")
    rows = results.first_attempt(_results(spark, d))
    rows = catalog.having_image(rows.where(~F.coalesce(F.col("prompt_type").isin("avoidance", "short_answer"), F.lit(False))), listing)
    return rows.select(F.col("attempt").alias("export_id"), "image_path", "run_id", "prompt_type")


def qa_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Messages two by two; a last one without an answer is left out."""
    rows = _results(spark, d).select("attempt", F.posexplode(X.pair_up(F.col("output"))).alias("n", "p"))
    return rows.select(F.col("attempt").alias("export_id"), "n", F.col("p.q").alias("question"), F.col("p.a").alias("answer"))


def conversation_statistics(spark: SparkSession, d: str) -> DataFrame:
    return results.statistics(_results(spark, d))


def collected_results(spark: SparkSession, d: str) -> DataFrame:
    """Of the list of each picture and run: its length, its first and last attempt."""
    rows = results.collect(_results(spark, d), keys=("run_id", "image_path"))
    return rows.select("run_id", "image_path", F.size("results").alias("n"), F.get("results", F.lit(0))["attempt"].alias("first"), F.element_at("results", -1)["attempt"].alias("last"))


def exported_results(spark: SparkSession, d: str) -> DataFrame:
    """The export of first attempts of known pictures, but for two prompt types: id, picture, messages and the first of them."""
    rows = results.export(_results(spark, d), table(spark, d, "annotations").select("image_path"), ("avoidance", "short_answer"))
    return rows.select("id", "image", F.size("conversations").alias("n"), F.get("conversations", F.lit(0))["from"].alias("role"), F.get("conversations", F.lit(0))["value"].alias("value"))


def picture_results(spark: SparkSession, d: str) -> DataFrame:
    """Every step of each picture at its place in the list that ``results.collect`` makes."""
    rows = results.collect(_results(spark, d)).select("image_path", F.posexplode("results").alias("pos", "r"))
    return rows.select("image_path", "pos", "r.run_id", "r.attempt", "r.step", "r.prompt_type", F.size("r.output").alias("n_messages"))


def counted_results(spark: SparkSession, d: str) -> DataFrame:
    """Pictures of each run, with those only claimed: for each picture of a run another one, told by ``#2``, is claimed."""
    rows = _results(spark, d)
    return results.count(rows, rows.select("run_id", F.concat("image_path", F.lit("#2")).alias("image_path")).distinct())


def cleaned_results(spark: SparkSession, d: str) -> DataFrame:
    return results.clean(_results(spark, d).withColumn("output", F.filter("output", lambda t: F.length(F.trim(t)) > 0))).select(F.col("attempt").alias("export_id"))


def gated_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs judged right by the length of their answers, none where the first isn't."""
    pairs = _results(spark, d).select("attempt", X.pair_up(F.col("output")).alias("pairs"))
    ok = F.transform("pairs", lambda p: F.length(F.trim(F.coalesce(p["a"], F.lit("")))) > 3)
    rows = pairs.select("attempt", F.explode(X.first_pair_gate(F.col("pairs"), ok)).alias("p"))
    return rows.select(F.col("attempt").alias("export_id"), F.col("p.q").alias("question"), F.col("p.a").alias("answer"))


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Answers that begin with true or false."""
    turns = _chats(spark, d).select("export_id", F.posexplode("conversations.value").alias("turn", "value"))
    return turns.withColumn("verdict", X.verdict(F.col("value"))).where("verdict is not null").select("export_id", "turn", "verdict")


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(X.sentences(F.array("text"))).alias("n", "s"))
    return rows.select("doc_id", "n", F.col("s.sentence").alias("sentence"))


def reduced_information(spark: SparkSession, d: str) -> DataFrame:
    """Every third sentence of a text taken away: characters kept and removed, and the share that is gone."""
    items = F.array("text")
    chosen = F.filter(F.sequence(F.lit(0), F.size(X.sentences(items))), lambda i: i % 3 == 0)
    kept, removed = X.split_by_selection(items, chosen)
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", "text", kept.alias("kept"), removed.alias("removed"))
    return rows.select("doc_id", X.total_length(F.col("kept")).alias("kept"), X.total_length(F.col("removed")).alias("removed"), F.round(X.reduction_ratio(F.col("kept"), F.array("text")), 6).alias("ratio"))


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the documents that are transcripts."""
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(X.parse_transcript(F.col("text"))).alias("n", "p"))
    return rows.select("doc_id", "n", F.col("p.q").alias("question"), F.col("p.a").alias("answer"))


def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the same text as one, named by the first digits of its hash."""
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.substring(F.sha2("text", 256), 1, 16).alias("hash"))
    return rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


def majority_answers(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent event type of each user, among equals the first."""
    return majority(table(spark, d, "events"), ["user_id"], "event_type", "event_id")


def explained_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answer of each user's events by the kind of the user: polar ones by two event types, whole values, or types; no contradictions."""
    kind = F.when(F.col("user_id") % 3 == 0, "yes/no").when(F.col("user_id") % 3 == 1, "number").otherwise("other")
    polar = F.when(F.col("event_type") == "purchase", "Yes").when(F.col("event_type") == "signup", "no")
    given = F.when(kind == "yes/no", polar).when(kind == "number", F.floor("value").cast("string")).otherwise(F.col("event_type"))
    rows = table(spark, d, "events").where("user_id is not null and event_id is not null").select("user_id", "event_id", kind.alias("kind"), given.alias("given"))
    listed = rows.groupBy("user_id", "kind").agg(in_order(F.col("given"), "event_id").alias("answers"))
    return listed.select("user_id", explained_answer(F.col("kind"), F.col("answers")).alias("answer")).where("answer is not null")


def numeric_modes(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent whole value of each user's events, among equals the first."""
    rows = table(spark, d, "events").select("user_id", "event_id", F.floor("value").cast("string").alias("value"))
    return majority(rows.where(F.col("value").try_cast("double").isNotNull()), ["user_id"], "value", "event_id")


def label_distances(spark: SparkSession, d: str) -> DataFrame:
    """Edits between the name and the type of each part, and whether they would count as one label."""
    rows = table(spark, d, "part").select("p_partkey", F.levenshtein("p_name", "p_type").alias("distance"), "p_name", "p_type")
    most = F.greatest(F.lit(1), F.floor((F.length("p_name") + F.length("p_type")) / 2 * 0.2))
    return rows.select("p_partkey", "distance", (F.col("distance") <= most).alias("same"))


def merged_labels(spark: SparkSession, d: str) -> DataFrame:
    """Every two attributes that follow one another somewhere, as the labels that are left of them."""

    @F.pandas_udf("array<string>")
    def merge(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([merge_labels([x, y]) for x, y in zip(a, b)])

    given = table(spark, d, "vg_attributes").select(F.explode("attributes.attributes").alias("l"))
    pairs = given.select(F.explode(F.arrays_zip(F.col("l").alias("a"), F.slice("l", 2, 1_000_000_000).alias("b"))).alias("p")).select("p.a", "p.b").where("a is not null and b is not null").distinct()
    return pairs.select("a", "b", F.array_join(merge("a", "b"), " | ").alias("merged"))


def padded_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths of pictures by ids with zeros before them."""
    return table(spark, d, "vg_images").select("image_id", F.concat(F.lit("coco/train2017/"), pad(F.col("coco_id")), F.lit(".jpg")).alias("path")).where("path is not null").distinct()


def relation_labels(spark: SparkSession, d: str) -> DataFrame:
    """Captions that tell of a relation."""
    rows = catalog.records(table(spark, d, "annotations"), "ann_id").select("ann_id", F.posexplode("captions").alias("n", "caption"))
    return rows.where(X.is_relation(F.col("caption"))).select("ann_id", "n")


def counting_statements(spark: SparkSession, d: str) -> DataFrame:
    """Counting questions of the chats as statements, with a number from their place."""
    turns = _chats(spark, d).select("export_id", F.posexplode("conversations.value").alias("turn", "value")).withColumn("question", F.regexp_replace("value", r"<image>\n?|\n?<image>", ""))
    rows = turns.where(F.col("question").startswith("How many"))
    return rows.select("export_id", "turn", X.count_statement(F.col("question"), F.col("export_id") % 4).alias("statement"))


def choices(spark: SparkSession, d: str) -> DataFrame:
    """Questions with options shuffled by a seed, with the letter of the right one."""
    turns = _chats(spark, d).select("export_id", F.posexplode("conversations.value").alias("turn", "value")).where(F.col("value").rlike(r"\nA\. "))
    rows = turns.select("export_id", "turn", X.multiple_choice(F.concat(F.lit("Question: "), F.regexp_replace("value", "<image>", "")), F.col("export_id").cast("string")).alias("c")).where("c is not null")
    return rows.select("export_id", "turn", "c.*")


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each document that count as statements and as captions, and the first of either."""
    lines = {"statement": X.long_lines(F.col("text")), "caption": X.caption_lines(F.col("text"))}
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", *[c.alias(n) for n, c in lines.items()])
    return rows.select("doc_id", *[f(F.col(n)).alias(f"{a}_{n}") for n in lines for a, f in (("n", F.size), ("first", lambda c: F.get(c, F.lit(0))))])


def kept_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of each export that ask, and those whose question holds a token."""
    pairs = F.filter(X.pair_up(F.col("output")), lambda p: p["q"].isNotNull())
    rows = _results(spark, d).select(F.col("attempt").alias("export_id"), pairs.alias("pairs"))
    return rows.select("export_id", F.size(X.keep_asking(F.col("pairs"), "colour")).alias("n_asking"), F.size(X.keep_token(F.col("pairs"), "What")).alias("n_token"))


def label_parts(spark: SparkSession, d: str) -> DataFrame:
    """What stands in and around the brackets of labels made of a record's data set and source."""
    label = F.concat(F.col("dataset"), F.lit(" ("), F.col("image_path"), F.lit(") ("), F.col("dataset"), F.lit(")"))
    rows = catalog.records(table(spark, d, "annotations").select("ann_id", "dataset", "image_path"), "ann_id").select("ann_id", label.alias("l"))
    return rows.select("ann_id", X.in_parentheses(F.col("l")).alias("inside"), X.without_parentheses(F.col("l")).alias("outside"))


def formatted_labels(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of each entry as one label, the first before the others."""
    rows = table(spark, d, "vg_attributes").select("rec_id", F.posexplode("attributes").alias("pos", "a")).select("rec_id", "pos", F.array_compact("a.attributes").alias("l"))
    return rows.where("size(l) > 0").select("rec_id", "pos", X.format_labels(F.col("l")).alias("label")).distinct()


def cut_answers(spark: SparkSession, d: str) -> DataFrame:
    """Messages after the last mark of the end of a thought, and questions with a hint at the form of their answer."""
    turns = _chats(spark, d).select("export_id", F.posexplode("conversations.value").alias("turn", "value")).where("value is not null")
    return turns.select("export_id", "turn", X.after_thinking(F.col("value"), "?").alias("after"), X.answer_hint(F.col("value"), "Answer yes or no.").alias("hinted"))


def selections(spark: SparkSession, d: str) -> DataFrame:
    """Numbers in the first brackets of each document, joined."""
    rows = table(spark, d, "documents").select("doc_id", X.selection(F.col("text")).alias("s")).where("s is not null")
    return rows.select("doc_id", F.array_join("s", ",").alias("numbers"))


def turn_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of transcripts with marked turns, of those that have two pairs. A short answer loses its full stop."""
    pair = lambda i: F.concat(F.lit("Turn "), i.cast("string"), F.lit("\nQuestion: Which of "), F.col("export_id").cast("string"), F.lit("?\nAnswer: "), F.repeat(F.lit("one "), i.cast("int")), F.col("run_id"), F.lit("."))
    text = F.array_join(F.transform(F.sequence(F.lit(1), (F.col("export_id") % 3 + 1).cast("int")), pair), "\n\n")
    rows = _chats(spark, d).where("run_id is not null").select("export_id", F.posexplode(X.parse_transcript(text, turns=2)).alias("n", "p"))
    return rows.select("export_id", "n", F.col("p.q").alias("question"), F.col("p.a").alias("answer"))


def stored_results(spark: SparkSession, d: str) -> DataFrame:
    """Results that a stored table still has after it was written in two parts and the empty ones of one run were cleaned away."""
    folder, rows = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}", _results(spark, d).where("run_id is not null").withColumn("error", F.lit(None).cast("struct<type string, message string>"))
    emptied = rows.withColumn("output", F.when(F.col("attempt") % 4 > 0, F.col("output")))
    for part in (0, 1):
        results.append(emptied.where(F.col("attempt") % 2 == part), folder)
    stored = lambda: spark.read.schema(results.SCHEMA).parquet(f"{folder}/results")
    results.clean_table(stored(), folder, "run-marten-02")
    return stored().select("run_id", F.col("attempt").alias("export_id"))


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Results with an error, by run and type; a fifth of the results have one."""
    error = F.when(F.col("attempt") % 5 == 0, F.struct(F.concat(F.lit("type "), F.col("attempt") % 2).alias("type"), F.lit("x").alias("message")))
    good, bad = results.split_errors(_results(spark, d).withColumn("error", error))
    return bad.groupBy("run_id", F.col("error.type").alias("type")).agg(F.count("*").alias("n")).unionByName(good.groupBy("run_id").agg(F.count("*").alias("n")).withColumn("type", F.lit("none")))


def streamed_results(spark: SparkSession, d: str) -> DataFrame:
    """Conversations that a stream exported from a results table that was written in two parts, with a run of the stream after each."""
    folder, rows = f"{shared_dir(spark)}/streamed-{uuid.uuid4().hex}", _results(spark, d).where("run_id is not null and image_path is not null").withColumn("error", F.lit(None).cast("struct<type string, message string>"))
    for part in (0, 1):
        results.append(rows.where(F.col("attempt") % 2 == part), folder)
        result_stream.export(spark, folder, f"{folder}/exported").awaitTermination()
    return spark.read.parquet(f"{folder}/exported").select("id", "image", F.size("conversations").alias("n"))


def generated_results(spark: SparkSession, d: str) -> DataFrame:
    """The generation loop over every record's captions with the offline model."""
    rows = catalog.records(table(spark, d, "annotations"), "ann_id").select(F.concat_ws("#", "image_path", "ann_id").alias("image_path"), F.coalesce("captions", F.array().cast("array<string>")).alias("information"))
    return run(rows, EchoClient, DISTRIBUTIONS["LLaVA"], "offline", Settings()).select("image_path", "step", "prompt_type", "output", "filtered_out", "error")


QUERIES = {
    f.__name__: f
    for f in (conversation_export, first_attempts, qa_pairs, conversation_statistics, collected_results, exported_results, picture_results, counted_results, cleaned_results, gated_pairs, verdicts, sentence_split, reduced_information, transcripts, content_hashes,
              majority_answers, explained_answers, numeric_modes, label_distances, merged_labels, padded_paths, relation_labels, counting_statements, choices, generated_results,
              text_lines, kept_pairs, label_parts, formatted_labels, cut_answers, selections, turn_transcripts, stored_results, dead_letters, streamed_results)
}

_CHATS = "ch AS (SELECT * FROM chat_exports QUALIFY row_number() OVER (PARTITION BY export_id ORDER BY exported_at) = 1)"
_TURNS = f"{_CHATS}, t AS (SELECT export_id, (g.i - 1)::INT AS turn, conversations[g.i].value AS value, len(conversations) AS n FROM ch, unnest(range(1, len(conversations) + 1)) g(i) WHERE true)"
_PAIRS = f"{_TURNS}, p AS (SELECT a.export_id, a.turn // 2 AS n, a.value AS question, b.value AS answer FROM t a JOIN t b ON a.export_id = b.export_id AND b.turn = a.turn + 1 WHERE a.turn % 2 = 0)"
_FIRST = f"{_CHATS}, f AS (SELECT * FROM ch QUALIFY export_id = min(export_id) OVER (PARTITION BY run_id, image))"
_SPLIT = "SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{3000}\\x{0085}]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x != '') AS s FROM documents WHERE text IS NOT NULL"
SQL = {
    "conversation_export": f"WITH {_TURNS} SELECT export_id, turn, CASE WHEN turn % 2 = 0 THEN 'human' ELSE 'gpt' END AS role, CASE WHEN turn = 0 THEN '<image>' || chr(10) ELSE '' END || replace(value, '<fill-in-the-blank>', '[blank]') AS value FROM t",
    "first_attempts": f"WITH {_FIRST} SELECT export_id, image AS image_path, run_id, prompt_type FROM f WHERE coalesce(prompt_type, '') NOT IN ('avoidance', 'short_answer') AND image IN (SELECT image_path FROM annotations WHERE image_path IS NOT NULL)",
    "qa_pairs": f"WITH {_PAIRS} SELECT export_id, n, question, answer FROM p",
    "conversation_statistics": f"WITH {_FIRST} SELECT count(DISTINCT image) AS n_images, count(*) AS n_conversations, sum(len(conversations))::BIGINT AS n_messages FROM f WHERE len(conversations) > 0 AND run_id IS NOT NULL AND image IS NOT NULL",
    "collected_results": f"WITH {_CHATS} SELECT run_id, image AS image_path, count(*)::INT AS n, min(export_id) AS \"first\", max(export_id) AS \"last\" FROM ch WHERE run_id IS NOT NULL AND image IS NOT NULL GROUP BY run_id, image",
    "exported_results": f"WITH {_FIRST} SELECT 'conversation_' || substr(sha256(run_id || '|' || image || '|' || export_id || '|0'), 1, 16) AS id, image, len(conversations)::INT AS n, 'human' AS role, '<image>' || chr(10) || replace(conversations[1].value, '<fill-in-the-blank>', '[blank]') AS value FROM f WHERE len(conversations) > 0 AND run_id IS NOT NULL AND coalesce(prompt_type, '') NOT IN ('avoidance', 'short_answer') AND image IN (SELECT image_path FROM annotations WHERE image_path IS NOT NULL)",
    "picture_results": f"WITH {_CHATS} SELECT image AS image_path, (row_number() OVER (PARTITION BY image ORDER BY run_id NULLS FIRST, export_id) - 1)::INT AS pos, run_id, export_id AS attempt, 0 AS step, prompt_type, coalesce(len(conversations), -1)::INT AS n_messages FROM ch WHERE image IS NOT NULL",
    "counted_results": f"WITH {_CHATS} SELECT run_id, 2 * count(DISTINCT image) + (count(*) > count(image))::INT AS n_images, count(DISTINCT image) AS n_empty FROM ch GROUP BY run_id",
    "cleaned_results": f"WITH {_TURNS} SELECT DISTINCT export_id FROM t WHERE len(trim(value)) > 0",
    "gated_pairs": f"WITH {_PAIRS} SELECT export_id, question, answer FROM p WHERE len(trim(coalesce(answer, ''))) > 3 AND export_id IN (SELECT export_id FROM p WHERE n = 0 AND len(trim(coalesce(answer, ''))) > 3)",
    "verdicts": f"WITH {_TURNS} SELECT export_id, turn, regexp_extract(lower(trim(value)), '^(true|false)\\b', 1) = 'true' AS verdict FROM t WHERE regexp_matches(lower(trim(value)), '^(true|false)\\b')",
    "sentence_split": f"WITH sp AS ({_SPLIT}) SELECT doc_id, (g.i - 1)::INT AS n, s[g.i] AS sentence FROM sp, unnest(range(1, len(s) + 1)) g(i) WHERE true",
    "reduced_information": f"""WITH sp AS ({_SPLIT}), e AS (SELECT doc_id, (g.i - 1) % 3 = 0 AS gone, len(s[g.i]) AS n FROM sp, unnest(range(1, len(s) + 1)) g(i) WHERE true),
 k AS (SELECT doc_id, coalesce(sum(n) FILTER (NOT gone), 0) + greatest(count(*) FILTER (NOT gone) - 1, 0) AS kept, coalesce(sum(n) FILTER (gone), 0) + greatest(count(*) FILTER (gone) - 1, 0) AS removed FROM e GROUP BY doc_id)
 SELECT d.doc_id, coalesce(kept, 0)::INT AS kept, coalesce(removed, 0)::INT AS removed, round(1 - coalesce(kept, 0)::DOUBLE / nullif(len(text), 0), 6) AS ratio FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id WHERE text IS NOT NULL""",
    "content_hashes": "SELECT substr(sha256(text), 1, 16) AS hash, min(doc_id) AS doc_id, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "majority_answers": "SELECT user_id, arg_max(event_type, (n, -f)) AS event_type FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2) GROUP BY user_id",
    "explained_answers": """WITH g AS (SELECT user_id, event_id, user_id % 3 AS k, CASE user_id % 3 WHEN 0 THEN CASE event_type WHEN 'purchase' THEN 'yes' WHEN 'signup' THEN 'no' END
  WHEN 1 THEN CASE WHEN floor(value) >= 0 THEN floor(value)::BIGINT::VARCHAR || '.0' END ELSE event_type END AS v FROM events),
 c AS (SELECT user_id, k, v, count(*) AS n, min(event_id) AS f, count(*) OVER (PARTITION BY user_id) AS kinds FROM g WHERE v IS NOT NULL GROUP BY user_id, k, v)
 SELECT user_id, arg_max(v, (n, -f)) AS answer FROM c WHERE k != 0 OR kinds = 1 GROUP BY user_id""",
    "numeric_modes": "SELECT user_id, arg_max(v, (n, -f)) AS value FROM (SELECT user_id, floor(value)::BIGINT::VARCHAR AS v, count(*) AS n, min(event_id) AS f FROM events WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY user_id",
    "label_distances": "SELECT p_partkey, levenshtein(p_name, p_type)::INT AS distance, levenshtein(p_name, p_type) <= greatest(1, floor((len(p_name) + len(p_type)) / 2 * 0.2)) AS same FROM part",
    "merged_labels": """WITH l AS (SELECT unnest(list_transform(attributes, lambda x: x.attributes)) AS l FROM vg_attributes),
 p AS (SELECT DISTINCT l[i] AS a, l[i + 1] AS b FROM (SELECT l, unnest(range(1, len(l))) AS i FROM l) WHERE l[i] IS NOT NULL AND l[i + 1] IS NOT NULL),
 k AS (SELECT a, b, regexp_matches(a, 'next to|on top of|below|above|beside|near|under|over|around|in front of|behind') = regexp_matches(b, 'next to|on top of|below|above|beside|near|under|over|around|in front of|behind') AS same FROM p)
 SELECT a, b, CASE WHEN same AND (contains(a, b) OR contains(b, a)) THEN CASE WHEN len(b) > len(a) THEN b ELSE a END
  WHEN same AND levenshtein(a, b) <= greatest(1, floor(0.2 * (len(a) + len(b)) / 2)) THEN CASE WHEN len(b) < len(a) THEN b ELSE a END ELSE a || ' | ' || b END AS merged FROM k""",
    "text_lines": """WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: len(trim(x)) > 10) AS s, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x != '') AS c FROM documents WHERE text IS NOT NULL)
 SELECT doc_id, len(s)::INT AS n_statement, s[1] AS first_statement, len(c)::INT AS n_caption, c[1] AS first_caption FROM l""",
    "kept_pairs": f"WITH {_PAIRS} SELECT ch.export_id, (count(*) FILTER (question NOT LIKE 'I see%' AND question LIKE '%?' AND NOT contains(lower(question), 'colour')))::INT AS n_asking, (count(*) FILTER (contains(question, 'What')))::INT AS n_token FROM ch LEFT JOIN p ON ch.export_id = p.export_id GROUP BY ch.export_id",
    "label_parts": "SELECT DISTINCT ann_id, nullif(split_part(split_part(l, '(', 2), ')', 1), '') AS inside, trim(split_part(l, ' (', 1)) AS outside FROM (SELECT ann_id, dataset || ' (' || image_path || ') (' || dataset || ')' AS l FROM annotations WHERE ann_id IS NOT NULL)",
    "formatted_labels": "WITH e AS (SELECT rec_id, unnest(range(len(attributes)))::INT AS pos, unnest(attributes) AS a FROM vg_attributes), l AS (SELECT rec_id, pos, list_filter(a.attributes, lambda x: x IS NOT NULL) AS l FROM e) SELECT DISTINCT rec_id, pos, l[1] || CASE WHEN len(l) > 1 THEN ' (' || array_to_string(list_transform(l[2:], lambda x: trim(x)), ', ') || ')' ELSE '' END AS label FROM l WHERE len(l) > 0",
    "cut_answers": f"WITH {_TURNS} SELECT export_id, turn, regexp_replace(string_split(value, '?')[-1], '^[\\s\\v\\p{{Z}}]+|[\\s\\v\\p{{Z}}]+$', '', 'g') AS after, CASE WHEN contains(lower(value), 'answer yes or no.') THEN value ELSE value || ' Answer yes or no.' END AS hinted FROM t WHERE value IS NOT NULL",
    "selections": r"SELECT DISTINCT doc_id, array_to_string(list_filter(list_transform(regexp_extract_all(regexp_extract(text, '\[([^\]]*)\]', 1), '[0-9]+'), lambda x: try_cast(x AS INT)), lambda x: x IS NOT NULL), ',') AS numbers FROM documents WHERE regexp_matches(text, '\[[^\]]*\]')",
    "turn_transcripts": f"WITH {_CHATS} SELECT export_id, n, 'Which of ' || export_id || '?' AS question, CASE n WHEN 0 THEN 'one ' || run_id ELSE 'one one ' || run_id || '.' END AS answer FROM ch, (VALUES (0), (1)) v(n) WHERE run_id IS NOT NULL AND export_id % 3 = 1",
    "stored_results": f"WITH {_CHATS} SELECT run_id, export_id FROM ch WHERE run_id IS NOT NULL AND NOT (run_id = 'run-marten-02' AND (export_id % 4 = 0 OR conversations IS NULL OR len(conversations) = 0))",
    "dead_letters": f"WITH {_CHATS} SELECT run_id, CASE WHEN export_id % 5 = 0 THEN 'type ' || export_id % 2 ELSE 'none' END AS type, count(*) AS n FROM ch GROUP BY 1, 2",
    "streamed_results": f"WITH {_CHATS} SELECT 'conversation_' || substr(sha256(run_id || '|' || image || '|' || export_id || '|0'), 1, 16) AS id, image, len(conversations)::INT AS n FROM ch WHERE len(conversations) > 0 AND run_id IS NOT NULL AND image IS NOT NULL",
    "padded_paths": "SELECT DISTINCT image_id, 'coco/train2017/' || CASE WHEN len(coco_id::VARCHAR) >= 12 THEN coco_id::VARCHAR ELSE lpad(coco_id::VARCHAR, 12, '0') END || '.jpg' AS path FROM vg_images WHERE coco_id IS NOT NULL",
    "relation_labels": "SELECT DISTINCT ann_id, (g.i - 1)::INT AS n FROM annotations, unnest(range(1, len(captions) + 1)) g(i) WHERE true AND regexp_matches(captions[g.i], 'next to|on top of|below|above|beside|near|under|over|around|in front of|behind')",
    "transcripts": """WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(text, 'Turn \\d{1,2}\\n', '', 'g'), '\\n\\nQuestion:', chr(1), 'g'), chr(1)), lambda x: true) AS parts, text FROM documents WHERE contains(text, 'Question:')),
 q AS (SELECT doc_id, g.i AS i, CASE WHEN g.i = 1 THEN substr(parts[1], position('Question:' IN parts[1]) + 9) ELSE parts[g.i] END AS x FROM s, unnest(range(1, len(parts) + 1)) g(i) WHERE true),
 r AS (SELECT doc_id, i, regexp_extract(x, '(?s)^\\s*(.*?)\\s*\\n\\s*Answer:\\s*(.*)$', 1) AS question, regexp_replace(regexp_extract(x, '(?s)^\\s*(.*?)\\s*\\n\\s*Answer:\\s*(.*)$', 2), '\\s+$', '') AS a, regexp_matches(x, '(?s)^\\s*(.*?)\\s*\\n\\s*Answer:\\s*(.*)$') AS ok FROM q)
 SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS n, question, CASE WHEN len(regexp_split_to_array(a, '\\s+')) < 3 THEN regexp_replace(a, '\\.$', '') ELSE a END AS answer FROM r WHERE ok AND doc_id NOT IN (SELECT doc_id FROM r WHERE ok AND (question = '' OR a = ''))""",
    # the steps of the rewriting in the survey's order; look-arounds by marks that are set and taken away, the singular by plain endings
    "counting_statements": f"""WITH {_TURNS}, q AS (SELECT export_id, turn, export_id % 4 AS k, regexp_replace(value, '<image>\\n?|\\n?<image>', '', 'g') AS question FROM t),
 a AS (SELECT *, regexp_replace(regexp_replace(question, '[^\\w\\s]$', ''), '^How many\\s+', '') AS x FROM q WHERE starts_with(question, 'How many')),
 b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(x, '\\bare there\\b', '', 'g'), '\\bthat are in\\b', 'in', 'g'), '\\bthat are\\b', '', 'g') AS y FROM a),
 c AS (SELECT *, regexp_replace(regexp_replace(y, '\\bare\\b(.)', 'that are\\1', 'g'), '\\bare$', '') AS z FROM b),
 d AS (SELECT *, CASE WHEN k = 1 THEN regexp_replace(replace(regexp_replace(replace(z, 'that is ', chr(2)), '\\bis ', '', 'g'), chr(2), 'that is '), '\\bare\\b', 'is', 'g') ELSE z END AS u FROM c),
 e AS (SELECT *, regexp_replace(regexp_replace(u, '\\bhave\\b', 'that have', 'g'), '\\bdo you\\b', 'that you', 'g') AS v FROM d),
 f AS (SELECT *, CASE WHEN k = 1 THEN array_to_string(list_transform(string_split(v, ' '), lambda w: CASE WHEN w IN ('people', 'men', 'women', 'children') THEN replace(replace(replace(w, 'people', 'person'), 'children', 'child'), 'men', 'man')
   WHEN len(w) < 3 OR w IN ('does', 'has', 'was', 'this', 'its', 'glasses', 'trousers', 'scissors', 'jeans') THEN w WHEN regexp_matches(w, '..ies$') THEN regexp_replace(w, 'ies$', 'y')
   WHEN regexp_matches(w, '(ss|x|zz|ch|sh|[^oa]us)es$') THEN regexp_replace(w, 'es$', '') WHEN regexp_matches(w, '[^sui]s$') THEN regexp_replace(w, 's$', '') ELSE w END), ' ') ELSE v END AS o FROM e),
 g AS (SELECT *, regexp_replace(o, '\\bdoes (?:the|this) (.+?) that have\\b', CASE WHEN k = 1 THEN 'that the \\1 has' ELSE 'that the \\1 have' END, 'g') AS w FROM f),
 h AS (SELECT *, regexp_replace(regexp_replace(w, '\\bcan you see\\b', 'that you can see', 'g'), '\\bcan be seen\\b', 'that can be seen', 'g') AS s FROM g)
 SELECT export_id, turn, trim(replace(CASE k WHEN 0 THEN 'There are no ' || s WHEN 1 THEN 'There is 1 ' || s ELSE 'There are ' || k || ' ' || s END, 'There are no of', 'There are none of')) AS statement FROM h""",
    "choices": f"""WITH {_TURNS}, q AS (SELECT export_id, turn, 'Question: ' || replace(value, '<image>', '') AS x FROM t WHERE regexp_matches(value, '\\nA\\. ')),
 o AS (SELECT *, regexp_extract(x, 'Question:\\s*([^\\n]*)', 1) AS question, regexp_extract_all(x, '(?m)^[A-E]\\.\\s*(.+?)\\s*$', 1)[1:4] AS taken FROM q),
 e AS (SELECT export_id, turn, question, taken, g.i AS i, taken[g.i] AS v FROM o, range(1, 5) g(i) WHERE g.i <= len(taken)),
 m AS (SELECT export_id, turn, question, list(v ORDER BY md5(export_id || '|' || (i - 1) || '|' || v), v) AS options, any_value(taken[1]) AS good, count(*) AS n FROM e GROUP BY 1, 2, 3)
 SELECT export_id, turn, question, options, chr((64 + list_position(options, good))::INT) AS answer FROM m WHERE n >= 2 AND question != ''""",
}
