"""One query per operator, each over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvetch.functions.rows import explode_rows
from kvetch.functions.text import fold_variants, fold_width, tokenize, without_words
from kvetch.operators import features, keywords, lexicon, model, pairs, segment, tagger, training
from kvetch.operators.merge import merge_classes as merged_classes
from kvetch.plans import jobs
from kvetch.session import java_charsets, scratch_folder
from kvetch.sources import files, sinks, tables
from registry import inputs

# Passes of the trained models; the SQL twins state them one by one.
PASSES = training.PASSES
# The join way of training and the weights of single texts take as many.
PASSES_BY_JOIN = PASSES


def _joined(tokens: str | Column) -> Column:
    return F.array_join(tokens, " ")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", tokenize(F.col("text")).alias("tokens"))


def _long(count: Column | str) -> Column:
    return (F.col(count) if isinstance(count, str) else count).cast("long")


# Scans

def scan_comments_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    nature = F.when(F.col("lang") == "en", -1).when(F.col("lang") == "fr", 0).when(F.col("lang") == "es", 1)
    return tables.scan_comments(inputs.comments(spark, sf_dir, nature), inputs.DAY)


def scan_messages_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_messages(inputs.messages(spark, sf_dir), inputs.DAY, inputs.HOUR)


def keyword_first_two_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.first_two_fields(inputs.part_lines(spark, sf_dir))


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.labelled_lines(inputs.document_lines(spark, sf_dir))


def dedupe_last_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.last_label_per_text(inputs.sentence_lines(spark, sf_dir))


def prediction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lines_to_score(inputs.document_lines(spark, sf_dir), True)


def prediction_lines_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lines_to_score(inputs.document_lines(spark, sf_dir), False)


def training_tokens_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With letter variants folded and stop words of the user's."""
    texts = jobs.training_tokens(
        inputs.document_lines(spark, sf_dir), variants=inputs.VARIANTS, stop_words=inputs.STOP_WORDS
    )
    return texts.select("doc_id", "label", _joined("tokens").alias("words"))


def training_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = jobs.training_tokens(inputs.document_lines(spark, sf_dir))
    return texts.select("doc_id", "label", _joined("tokens").alias("words"))


def encoding_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: GBK those whose letters it has, UTF-8 the others."""
    texts = inputs.documents(spark, sf_dir, "doc_id", "text")
    line = F.concat(F.concat_ws("\t", "doc_id", F.translate("text", "\n", " ")), F.lit(" 手机"))
    marked = texts.select(line.alias("line"), (~F.rlike("text", F.lit(r"[^\x00-\x7Féèê]"))).alias("gbk"))
    with java_charsets(spark):
        encoded = F.encode("line", "GBK").cast("string")
        coded = marked.select(F.when(F.col("gbk"), encoded).otherwise(F.col("line")).alias("value"), "gbk")
    folder = scratch_folder(spark, "encoded")
    coded.write.partitionBy("gbk").text(folder)
    lines = files.read_lines(spark, [f"{folder}/gbk=true", f"{folder}/gbk=false"])
    fields = F.split("line", "\t")
    return lines.select(fields[0].cast("long").alias("doc_id"), fields[1].alias("text"))


# Sinks

def _table(spark: SparkSession) -> tuple[str, str]:
    name = f"kvetch_{uuid.uuid4().hex}"
    return name, scratch_folder(spark, name)


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of each type a sink takes."""
    return inputs.documents(spark, sf_dir, "doc_id", "text", "lang", "n_chars").select(
        "doc_id",
        "text",
        F.length("lang").alias("width"),
        (F.col("lang") == "en").alias("english"),
        (F.col("n_chars") / 4).alias("quarter"),
    )


def sink_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, the second time in another column order and as fewer files."""
    table, location = _table(spark)
    rows = _columns(spark, sf_dir)
    sinks.save_by_date(rows, table, inputs.DAY, location=location)
    sinks.save_by_date(rows.select(*reversed(rows.columns)), table, inputs.DAY, files=2)
    sinks.save_by_date(rows.where("english"), table, inputs.DAY + 1)
    return spark.table(table)


def sink_string_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, location = _table(spark)
    sinks.save_by_date(_columns(spark, sf_dir), table, "it's day 1", "string", location=location)
    return spark.table(table)


def sink_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column list that the sink of these rows has, beside what the rows hold."""
    rows = _columns(spark, sf_dir)
    return rows.agg(_long(F.count("*")).alias("n")).withColumn("ddl", F.lit(sinks.column_ddl(rows.schema)))


def lines_out_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written and read again, with quotes, blanks at both ends and NULLs."""
    texts = inputs.documents(spark, sf_dir, "doc_id", "text", "lang").select(
        F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 4 != 1, F.col("lang")).alias("lang"),
        F.concat(F.lit('  "say \\"hi\\" '), F.translate("text", "\n\t", "  "), F.lit(' now"  ')).alias("text"),
    )
    folder = scratch_folder(spark, "lines")
    sinks.save_lines(texts, folder)
    return spark.read.text(folder).select(F.col("value").alias("line"))


def sink_hour_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hours written, one of them cleared by an empty batch."""
    table, location = _table(spark)
    rows = tables.scan_messages(inputs.messages(spark, sf_dir), inputs.DAY, inputs.HOUR)
    sinks.save_by_hour(rows, table, inputs.DAY, inputs.HOUR, location)
    sinks.save_by_hour(rows, table, inputs.DAY, inputs.HOUR + 1)
    sinks.save_by_hour(rows.where(F.lit(False)), table, inputs.DAY, inputs.HOUR + 1)
    return spark.table(table)


# Text

def fold_width_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", inputs.wide_text().alias("wide"))
    return wide.select("doc_id", F.length("wide").cast("long").alias("chars"), fold_width(F.col("wide")).alias("folded"))


def fold_variant_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.documents(spark, sf_dir, "doc_id", "text")
    return texts.select("doc_id", fold_variants(F.col("text"), inputs.VARIANTS).alias("folded"))


def fold_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases ahead of the letters in them."""
    texts = inputs.documents(spark, sf_dir, "doc_id", "text")
    return texts.select("doc_id", fold_variants(inputs.some_text(), inputs.PHRASES).alias("folded"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.documents(spark, sf_dir, "doc_id", "text")
    found = texts.select("doc_id", tokenize(F.lower("text"), normalized=False).alias("tokens"))
    return found.select("doc_id", _long(F.size("tokens")).alias("n"), _joined("tokens").alias("words"))


def normalized_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", inputs.wide_text().alias("wide"))
    return wide.select("doc_id", _joined(tokenize(F.col("wide"), variants=inputs.VARIANTS)).alias("words"))


def stop_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("doc_id", _joined(without_words(F.col("tokens"), inputs.STOP_WORDS)).alias("words"))


def tokenize_with_nature(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = lexicon.tag_tokens(_tokens(spark, sf_dir), "tokens", inputs.lexicon(spark))
    return tagged.withColumn("pos", _long("pos"))


def tokenize_with_nature_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, by the natures that the documents' words have behind each other."""
    # Dealt out before they are rows of a word each, texts move once and take less room; the window's rows then lie where it wants them.
    dealt = inputs.documents(spark, sf_dir, "doc_id", "text").repartition("doc_id")
    texts = dealt.select("doc_id", tokenize(F.col("text")).alias("tokens"))
    words = explode_rows(texts, "tokens", "word", "doc_id", pos="pos")
    before = F.lag("word").over(Window.partitionBy("doc_id").orderBy("pos"))
    tagged = words.select("doc_id", "pos", "word", inputs.nature_behind(before).alias("nature"))
    turns = inputs.spread(inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    texts = turns.select("conv_id", "turn", tokenize(F.col("text")).alias("tokens"))
    found = tagger.with_natures(texts, "tokens", tagger.train_tagger(tagged, "doc_id"))
    return found.select("conv_id", "turn", _joined("natures").alias("natures"))


def lexicon_with_user_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents, with the words of the benchmark put in by a user."""
    words = features.vocabulary(_tokens(spark, sf_dir))
    word = F.col("word")
    nature = F.when(word.endswith("tion"), "n").when(word.endswith("ly"), "d").when(word.endswith("ing"), "v").otherwise("x")
    base = words.select("word", nature.alias("nature"))
    items = inputs.read(spark, sf_dir, "benchmark").select(tokenize(F.col("text")).alias("tokens"))
    return lexicon.with_user_words(base, features.vocabulary(items).withColumn("nature", F.lit("mzm")))


def _segmented(spark: SparkSession, sf_dir: str, in_tasks: bool | None) -> DataFrame:
    solid = inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", inputs.solid_text().alias("solid"))
    words = spark.createDataFrame([(word,) for word in inputs.SEGMENT_WORDS], "word string")
    cut = segment.segment(solid, "solid", words, in_tasks=in_tasks)
    return cut.select("doc_id", _joined("tokens").alias("words"))


def segment_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmented(spark, sf_dir, None)


def segment_longest_match_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmented(spark, sf_dir, False)


def segment_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By all words of the documents that have at least three letters."""
    solid = inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", inputs.solid_text().alias("solid"))
    words = features.vocabulary(_tokens(spark, sf_dir)).where(F.length("word") >= inputs.LEXICON_LETTERS)
    return segment.segment(solid, "solid", words).select("doc_id", _joined("tokens").alias("words"))


def segment_best_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, by how often each word occurs in the documents and with words of a user's."""
    turns = inputs.spread(inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    solid = turns.select("conv_id", "turn", F.regexp_replace(F.lower("text"), r"[^\p{L}]", "").alias("solid"))
    found = explode_rows(_tokens(spark, sf_dir), "tokens", "word", "doc_id")
    counted = found.groupBy("word").agg(F.count("*").alias("frequency"))
    users = spark.createDataFrame([(word,) for word in inputs.SEGMENT_WORDS], "word string")
    cut = segment.segment_by_frequency(solid, "solid", segment.with_user_frequencies(counted, users))
    return cut.select("conv_id", "turn", _joined("tokens").alias("words"))


# Keywords

def keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = keywords.parse_rules(inputs.rule_lines(spark, sf_dir))
    return rules.select(
        "doc_id", _long("pos").alias("pos"), "class",
        F.array_join("subjects", "|").alias("subjects"), F.array_join("descriptors", "|").alias("descriptors"),
    )


def _rule_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.build_dictionary(keywords.parse_rules(inputs.rule_lines(spark, sf_dir)))


def keyword_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_dictionary(spark, sf_dir)


def ambiguous_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.ambiguous_words(_rule_dictionary(spark, sf_dir))


def _some_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, NULL for some."""
    return inputs.documents(spark, sf_dir, "doc_id", "text").select("doc_id", tokenize(inputs.some_text()).alias("tokens"))


def _keyword_classes(spark: SparkSession, sf_dir: str, max_literals: int = keywords.MAX_LITERALS) -> DataFrame:
    hits = keywords.keyword_hits(_some_tokens(spark, sf_dir), inputs.dictionary(spark), max_literals=max_literals)
    return keywords.classify_by_keywords(hits)


def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = keywords.keyword_hits(_some_tokens(spark, sf_dir), inputs.dictionary(spark))
    return hits.select("doc_id", keywords.matched_words().alias("words"))


def keyword_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyword_classes(spark, sf_dir).select("doc_id", F.array_join("key_classes", ",").alias("class"))


def keyword_classes_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyword_classes(spark, sf_dir, 0).select(
        "doc_id", keywords.matched_words().alias("words"), F.array_join("key_classes", ",").alias("class")
    )


def keyword_hits_large_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of words: the dictionary of the documents' own rule lines."""
    hits = keywords.keyword_hits(_some_tokens(spark, sf_dir), _rule_dictionary(spark, sf_dir))
    return hits.select("doc_id", keywords.matched_words().alias("words"))


def keyword_vote_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = explode_rows(_keyword_classes(spark, sf_dir), "votes", "vote", "doc_id", pos="pos")
    return votes.select("doc_id", _long(F.col("pos") + 1).alias("place"), F.col("vote.class").alias("class"), F.col("vote.votes").alias("votes"))


# Features

def _labelled_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.labelled_texts(spark, sf_dir).select("doc_id", "label", tokenize(F.col("text")).alias("tokens"))


def word_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.word_class_counts(_labelled_tokens(spark, sf_dir))


def selected_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.selected_words(_labelled_tokens(spark, sf_dir), min_total=2)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(_labelled_tokens(spark, sf_dir))


def class_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.class_prior(_labelled_tokens(spark, sf_dir)).withColumn("share", F.round("share", 9))


def features_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in terms of the labelled ones' words."""
    return features.binary_features(_tokens(spark, sf_dir), vocabulary(spark, sf_dir))


def features_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.count_features(_tokens(spark, sf_dir), vocabulary(spark, sf_dir))


def features_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents with their labels, in terms of the words selected from them."""
    texts = _labelled_tokens(spark, sf_dir)
    return features.binary_features(texts, features.selected_words(texts, min_total=2))


# Classifier. Each query trains the model it applies.

def _plain_model(spark: SparkSession, sf_dir: str) -> model.Model:
    return training.train(_labelled_tokens(spark, sf_dir), PASSES)


def _comment_model(spark: SparkSession, sf_dir: str) -> model.Model:
    return jobs.train_for_comments(inputs.document_lines(spark, sf_dir), inputs.dictionary(spark), PASSES)


def _message_model(spark: SparkSession, sf_dir: str) -> model.Model:
    return jobs.train_for_messages(inputs.sentence_lines(spark, sf_dir))


def _rounded(column: str) -> Column:
    """To the digits that engines agree on after all passes."""
    return F.round(column, 4).alias(column)


def train_term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = training.train(_labelled_tokens(spark, sf_dir), PASSES)
    return trained.terms.select("word", "label", _rounded("f"))


def train_term_weights_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = training.train(_labelled_tokens(spark, sf_dir), PASSES_BY_JOIN, in_tasks=False)
    return trained.terms.select("word", "label", _rounded("f"))


def train_all_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many passes as training takes unless told otherwise."""
    trained = training.train(_labelled_tokens(spark, sf_dir))
    return trained.terms.select("word", "label", _rounded("f"))


def train_document_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _labelled_tokens(spark, sf_dir)
    steps = training.training_passes(texts)
    weights = training.text_weights(texts, (next(steps) for _ in range(PASSES_BY_JOIN - 1)))
    steps.close()
    return weights.select("doc_id", "label", _rounded("weight"))


def _distribution(spark: SparkSession, sf_dir: str, by_join: bool) -> DataFrame:
    trained = _plain_model(spark, sf_dir)
    texts = _tokens(spark, sf_dir)
    if by_join:
        scored = model.score_by_join(texts.withColumn("tokens", F.array_distinct("tokens")), "tokens", trained)
    else:
        scored = model.with_distribution(texts, trained)
    rows = explode_rows(scored, model.ranked_classes(trained), "row", "doc_id", _long("known").alias("known"))
    return rows.select("doc_id", "known", F.col("row.class").alias("class"), F.round("row.p", 4).alias("p"))


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distribution(spark, sf_dir, False)


def class_distribution_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distribution(spark, sf_dir, True)


def predict_with_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and each in full-width forms, of which the model knows nothing."""
    trained = _plain_model(spark, sf_dir)
    texts = inputs.documents(spark, sf_dir, "doc_id", "text")
    both = explode_rows(texts, F.array(F.col("text"), inputs.wide_text()), "text", "doc_id")
    found = both.select("doc_id", tokenize(F.lower("text"), normalized=False).alias("tokens"))
    best = model.with_best_class(model.with_distribution(found, trained), trained)
    return best.select("doc_id", "classid", _rounded("cvalue"))


def predict_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = _plain_model(spark, sf_dir)
    top = model.with_top_classes(model.with_distribution(_tokens(spark, sf_dir), trained), trained)
    return top.select(
        "doc_id", F.array_join("pred_classes", ",").alias("classes"), F.round(F.col("pred_values")[0], 4).alias("p1")
    )


def _merged(spark: SparkSession, sf_dir: str, **thresholds: float) -> DataFrame:
    trained = _comment_model(spark, sf_dir)
    top = model.with_top_classes(model.with_distribution(_keyword_classes(spark, sf_dir), trained), trained)
    merged = merged_classes(F.col("key_classes"), F.col("pred_classes"), F.col("pred_values")[0], **thresholds)
    return top.select(
        "doc_id", F.array_join("key_classes", ",").alias("keyclass"), F.array_join("pred_classes", ",").alias("predclass"),
        F.array_join(merged, ",").alias("class"),
    )


def merge_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


def merge_classes_cautious(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model never replaces classes, so those it doesn't name stay too."""
    return _merged(spark, sf_dir, over_common=1.0, over_keywords=1.0)


def classify_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = tables.scan_comments(inputs.comments(spark, sf_dir), inputs.DAY)
    return jobs.classify_comments(scanned, inputs.dictionary(spark), _comment_model(spark, sf_dir))


def score_messages_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = tables.scan_messages(inputs.messages(spark, sf_dir), inputs.DAY, inputs.HOUR)
    scored = jobs.score_messages(scanned, _message_model(spark, sf_dir))
    return scored.withColumn("cvalue", _rounded("cvalue"))


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.document_lines(spark, sf_dir)
    scored = jobs.score_lines(lines, _message_model(spark, sf_dir), has_label=True)
    return scored.withColumn("confidence", _rounded("confidence"))


def training_fit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = jobs.training_fit_report(inputs.document_lines(spark, sf_dir), PASSES)
    return report.withColumn("confidence", _rounded("confidence"))


# Pairs

def _pairs(spark: SparkSession, sf_dir: str, in_tasks: bool | None) -> DataFrame:
    content = tables.scan_all_comments(inputs.comments(spark, sf_dir))
    texts = content.select(tokenize(F.col("content")).alias("tokens"))
    return pairs.noun_predicate_pairs(texts, inputs.lexicon(spark), in_tasks=in_tasks)


def noun_predicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, None)


def noun_predicate_pairs_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with letter variants folded and some words left out: what was ``étion`` may now be ``etion``."""
    return jobs.count_pairs(
        inputs.comments(spark, sf_dir), inputs.lexicon(spark), variants=inputs.VARIANTS, stop_words=["are", "eau"]
    )


def noun_predicate_pairs_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_comments_by_day": scan_comments_by_day,
    "scan_messages_by_hour": scan_messages_by_hour,
    "keyword_first_two_fields": keyword_first_two_fields,
    "labelled_lines": labelled_lines,
    "dedupe_last_label": dedupe_last_label,
    "prediction_lines": prediction_lines,
    "prediction_lines_unlabelled": prediction_lines_unlabelled,
    "training_tokens": training_tokens,
    "training_tokens_folded": training_tokens_folded,
    "encoding_fallback": encoding_fallback,
    "sink_partition_roundtrip": sink_partition_roundtrip,
    "sink_string_partition": sink_string_partition,
    "sink_ddl": sink_ddl,
    "sink_hour_roundtrip": sink_hour_roundtrip,
    "lines_out_roundtrip": lines_out_roundtrip,
    "fold_width": fold_width_forms,
    "fold_variants": fold_variant_letters,
    "fold_phrases": fold_phrases,
    "tokenize": tokens,
    "normalized_tokens": normalized_tokens,
    "stop_word_filter": stop_word_filter,
    "tokenize_with_nature": tokenize_with_nature,
    "tokenize_with_nature_in_context": tokenize_with_nature_in_context,
    "lexicon_with_user_words": lexicon_with_user_words,
    "segment_longest_match": segment_longest_match,
    "segment_longest_match_by_join": segment_longest_match_by_join,
    "segment_large_lexicon": segment_large_lexicon,
    "segment_best_path": segment_best_path,
    "keyword_rules": keyword_rules,
    "keyword_dictionary": keyword_dictionary,
    "ambiguous_keywords": ambiguous_keywords,
    "keyword_hits": keyword_hits,
    "keyword_hits_large_dictionary": keyword_hits_large_dictionary,
    "keyword_classes": keyword_classes,
    "keyword_classes_by_join": keyword_classes_by_join,
    "keyword_vote_top3": keyword_vote_top3,
    "word_class_counts": word_class_counts,
    "selected_words": selected_words,
    "vocabulary": vocabulary,
    "class_prior": class_prior,
    "features_binary": features_binary,
    "features_counts": features_counts,
    "features_labelled": features_labelled,
    "train_term_weights": train_term_weights,
    "train_term_weights_by_join": train_term_weights_by_join,
    "train_all_passes": train_all_passes,
    "train_document_weights": train_document_weights,
    "class_distribution": class_distribution,
    "class_distribution_by_join": class_distribution_by_join,
    "predict_with_gate": predict_with_gate,
    "predict_top3": predict_top3,
    "merge_classes": merge_classes,
    "merge_classes_cautious": merge_classes_cautious,
    "classify_comments": classify_comments,
    "score_messages_hourly": score_messages_hourly,
    "score_lines": score_lines,
    "training_fit_report": training_fit_report,
    "noun_predicate_pairs": noun_predicate_pairs,
    "noun_predicate_pairs_folded": noun_predicate_pairs_folded,
    "noun_predicate_pairs_by_join": noun_predicate_pairs_by_join,
}
