"""All stages from artifacts to slides over a run store, each written as a table and skipped if it is there."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import word_count
from tessella.operators import answers, chunking, enrich, lineage, quality, state, synthesis
from tessella.sources.store import Store


@dataclass
class Options:
    """Settings of a run."""

    budget: int = chunking.BUDGET
    overlap: int = chunking.OVERLAP
    provider: Callable[[], enrich.Provider] = enrich.Extractive
    policy: enrich.Policy = field(default_factory=enrich.Policy)
    partitions: int | None = None
    reviews: int = 3
    least_words: float = 0.6
    slides: tuple[int, int] = (80, 100)


class Pipeline:
    """A run: `run(artifacts)` writes chunks, summaries, drafts, reviews and slides below the store's folder.

    A stage whose table is there is not run again. Summaries are resumed by chunk: only chunks without a good summary go
    to the provider, so a run that was cut off pays for no answer twice.
    """

    def __init__(self, spark: SparkSession, root: str, options: Options | None = None):
        self.store, self.options = Store(spark, root), options or Options()

    def run(self, artifacts: DataFrame, until: str | None = None) -> DataFrame:
        """Runs the stages up to `until`, all without it, and gives the table of the last."""
        last = None
        for name, stage in (("artifacts", lambda: artifacts), ("chunks", self.chunks), ("summaries", self.summaries), ("drafts", self.draft), ("reviews", self.review), ("slides", self.slides)):
            if name == "summaries" or not self.store.exists(name):
                made = stage()
                if made is not None:
                    self.store.save(name, made)
            last = self.store.load(name)
            if name == until:
                break
        return last

    def chunks(self) -> DataFrame:
        made = chunking.chunks(self.store.load("artifacts"), self.options.budget, self.options.overlap)
        source = F.get("source_locations", 0)["source_file"]
        return made.withColumn("source_file", source).withColumn("chunk_id", F.sha2(F.concat_ws("\x1f", "document_id", F.col("sequence_index").cast("string"), "content"), 256))

    def summaries(self) -> None:
        """Adds summaries of the chunks that have none or a failed one."""
        chunks = self.store.load("chunks")
        if self.store.exists("summaries"):
            chunks = state.pending(chunks, self.store.load("summaries").filter("status = 'success'"), "chunk_id")
        if chunks.isEmpty():
            return
        o = self.options
        made = enrich.fallback(enrich.enrich(synthesis.chunk_prompt(chunks), "chunk_id", "prompt", o.provider, o.policy, o.partitions))
        about = chunks.select("chunk_id", "document_id", "source_file", "section_title", "heading_path", "sequence_index")
        rows = made.join(about, "chunk_id").withColumn("summary_id", F.sha2(F.concat(F.lit("summary"), "chunk_id"), 256)).withColumn("summarized_at", F.current_timestamp())
        self.store.upsert("summaries", rows, "summary_id", "summarized_at")

    def draft(self) -> DataFrame:
        """Version 1: a section for each group of summaries, its text by the provider, its confidence the members' mean."""
        good = self.store.load("summaries").filter("status = 'success'").withColumn("provenance_id", F.col("summary_id"))
        member = F.struct("sequence_index", "document_id", "summary_id", "chunk_id", "summary")
        groups = good.groupBy(synthesis.section_key(F.col("section_title"), F.col("heading_path")).alias("heading")).agg(F.array_sort(F.collect_list(member)).alias("m"), F.avg("confidence").alias("confidence"))
        prompts = groups.select("heading", F.concat(F.lit("Section: "), "heading", F.lit("\n\n"), F.array_join(F.transform("m", lambda x: x["summary"]), "\n")).alias("prompt"))
        texts = enrich.enrich(prompts, "heading", "prompt", self.options.provider, self.options.policy, self.options.partitions).select("heading", F.col("answer").alias("content"))
        ids = lambda k: F.transform("m", lambda x: x[k])
        made = groups.join(texts, "heading", "left").select(
            F.lit("draft").alias("draft_id"), F.sha2(F.concat(F.lit("section"), "heading"), 256).alias("section_id"), F.lit(1).alias("version"), F.xxhash64("heading").alias("pos"), "heading", F.lit(1).alias("level"),
            F.coalesce("content", F.lit("")).alias("content"), ids("chunk_id").alias("source_chunk_ids"), ids("summary_id").alias("source_summary_ids"), "confidence",
        )
        return made

    def review(self) -> DataFrame:
        """Reviews the draft and refines it until nothing is to be changed, at most `reviews` times; the last round is only a review.

        A refined draft that lost too many words is not taken and ends the loop. Refined sections keep lineage and
        confidence of the old section of the same heading.
        """
        summaries, reviews = self.store.load("summaries"), None
        for n in range(1, self.options.reviews + 1):
            draft = self.store.last_version("drafts")
            found = answers.rule_review(draft, lineage.unknown_references(draft, summaries)).withColumn("iteration", F.lit(n))
            reviews = found if reviews is None else reviews.unionByName(found)
            wanted = answers.feedback(found)
            if n == self.options.reviews or wanted.isEmpty():
                break
            refined = self._refined(draft, wanted, n + 1)
            before, after = (x.agg(F.coalesce(F.sum(word_count(F.col("content"))), F.lit(0))).first()[0] for x in (draft, refined))
            if after < self.options.least_words * before:
                break
            self.store.save("drafts.next", refined)
            self.store.save("drafts", self.store.load("drafts.next"), mode="append")
            self.store.drop("drafts.next")
        return reviews

    def _refined(self, draft: DataFrame, wanted: DataFrame, version: int) -> DataFrame:
        """Sections to be changed are asked for again; the others stay."""
        targets = draft.join(wanted.select("draft_id", F.col("text").alias("_why")), "draft_id")
        prompts = targets.filter(F.contains("_why", F.col("section_id"))).select("section_id", F.concat(F.lit("Refine: "), F.col("_why"), F.lit("\n\n"), "content").alias("prompt"))
        texts = enrich.enrich(prompts, "section_id", "prompt", self.options.provider, self.options.policy, self.options.partitions).filter("status = 'success'").select("section_id", F.col("answer").alias("_new"))
        return draft.join(texts, "section_id", "left").withColumn("content", F.coalesce("_new", "content")).withColumn("version", F.lit(version)).select(*draft.columns)

    def slides(self) -> DataFrame:
        least, most = self.options.slides
        return synthesis.numbered_slides(synthesis.allocate(self.store.last_version("drafts"), least=least, most=most))

    def gates(self) -> DataFrame:
        """Gates over what was written."""
        summaries, draft = self.store.load("summaries"), self.store.last_version("drafts")
        expected = draft.select("heading").limit(0)
        return quality.all_gates(quality.confidence_gate(summaries, "summary_confidence"), quality.confidence_gate(draft, "draft_confidence"), quality.completeness_gate(draft, expected, summaries))
