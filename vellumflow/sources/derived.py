"""Workflow tables derived from a directory of raw event and document parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vellumflow import vocabulary as V
from vellumflow.functions.text import leading_sentences


def _k() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def _pick(selector: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), selector)


class Derived:
    """Lazily derived tables over ``<root>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A raw table; its footer is read once."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._raw[name]

    @staticmethod
    def as_job_events(events: DataFrame) -> DataFrame:
        """The event-log form of raw events; also applies to a stream of them."""
        a = (_k() % 3 + 1).cast("int")
        kind = F.col("event_type")

        def by_kind(done: str, failed: str, other: str) -> Column:
            return F.when(kind == "purchase", done).when(kind == "error", failed).otherwise(other)

        return events.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.concat(
                _pick(a, ["ExtractionJob", "SummarizationJob", "SharePointUpload"]),
                by_kind("Completed", "Failed", "Started"),
            ).alias("event_type"),
            ((F.col("user_id") * 100 + F.dayofmonth("ts")) * 10 + a).alias("run_id"),
            _pick(a, [x.name for x in V.AGENTS]).alias("agent"),
            _pick(a, [x.principal for x in V.AGENTS]).alias("sp_used"),
            F.col("user_id").cast("string").alias("triggered_by"),
            F.col("ts").alias("timestamp"),
            by_kind("SUCCESS", "FAILED", "RUNNING").alias("status"),
            F.col("props").alias("details"),
        )

    def job_events(self) -> DataFrame:
        return self.as_job_events(self.raw("events"))

    def linked_events(self) -> DataFrame:
        return self.linked(self.job_events())

    @staticmethod
    def linked(ev: DataFrame) -> DataFrame:
        """The event log as the agents write it: runs are linked through
        ``details``, and every upload carries run id 0 (a third of all rows)."""
        upload = F.col("agent") == V.UPLOAD.name
        details = (
            F.when(
                F.col("agent") == V.EXTRACTION.name,
                F.concat(F.lit('{"document_path":"/source_pdfs/patient_'), F.floor(F.col("run_id") / 10).cast("string"), F.lit('.pdf"}')),
            )
            .when(
                F.col("agent") == V.SUMMARIZATION.name,
                F.concat(F.lit('{"extraction_run_id":'), (F.col("run_id") - 1).cast("string"), F.lit("}")),
            )
            .otherwise(F.concat(F.lit('{"summarization_run_id":'), (F.col("run_id") - 1).cast("string"), F.lit("}")))
        )
        return ev.withColumns(
            {"details": details, "run_id": F.when(upload, F.lit(V.NO_RUN).cast("long")).otherwise(F.col("run_id"))}
        )

    def conversation_state(self) -> DataFrame:
        wf = (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("wf")
        days = self.raw("events").groupBy(wf, "user_id").agg(
            F.min("ts").alias("triggered_at"), F.max(_k() % 3 + 1).alias("last_a")
        )
        a = F.col("last_a")
        return days.select(
            F.col("wf").cast("string").alias("state_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.concat(F.lit("/source_pdfs/patient_"), F.col("wf").cast("string"), F.lit(".pdf")).alias("document_path"),
            (F.col("wf") * 10 + 1).alias("extraction_run_id"),
            F.when(a >= 2, F.col("wf") * 10 + 2).alias("summarization_run_id"),
            F.when(a == 1, V.EXTRACTING).when(a == 2, V.SUMMARIZING).otherwise(V.DONE).alias("current_stage"),
            "triggered_at",
            F.when(a == 3, V.WF_COMPLETED).otherwise(V.IN_PROGRESS).alias("status"),
        )

    @staticmethod
    def _run(doc: Column, agent: int) -> Column:
        return ((doc % 150) * 100 + doc % 30 + 1) * 10 + agent

    @staticmethod
    def _at(start: str, doc: Column) -> Column:
        minutes = F.make_dt_interval(F.lit(0), F.lit(0), doc.cast("int"))
        return F.lit(start).cast("timestamp_ntz") + minutes

    def extracted_documents(self) -> DataFrame:
        doc, text = F.col("doc_id"), F.col("text")
        return self.raw("documents").select(
            F.concat(F.lit("extract_"), doc.cast("string")).alias("extraction_id"),
            self._run(doc, 1).alias("extraction_run_id"),
            F.concat(F.lit("/source_pdfs/patient_"), doc.cast("string"), F.lit(".pdf")).alias("document_path"),
            text.alias("extracted_text"),
            (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int").alias("page_count"),
            self._at("2024-01-01 00:00:00", doc).alias("extracted_at"),
            F.lit(V.EXTRACTION.principal).alias("extracted_by"),
        )

    def summaries(self) -> DataFrame:
        doc, text = F.col("doc_id"), F.col("text")
        body = leading_sentences(text)
        return self.raw("documents").select(
            F.concat(F.lit("summary_"), doc.cast("string")).alias("summary_id"),
            self._run(doc, 2).alias("summarization_run_id"),
            self._run(doc, 1).alias("extraction_run_id"),
            body.alias("summary_text"),
            F.format_string(
                '{"original_length": %d, "summary_length": %d}', F.char_length(text), F.char_length(body)
            ).alias("document_metadata"),
            self._at("2024-01-01 00:10:00", doc).alias("summarized_at"),
            F.lit(V.SUMMARIZATION.principal).alias("summarized_by"),
        )

    def messages(self) -> DataFrame:
        user, kind = F.col("user_id").cast("string"), F.col("event_type")
        return self.raw("events").select(
            "event_id",
            user.alias("user_id"),
            "ts",
            F.when(kind == "signup", F.concat(F.lit("Extract /source_pdfs/patient_"), user, F.lit(".pdf please")))
            .when(kind == "view", "What's the STATUS of my workflow?")
            .when(kind == "click", "Tell me about treatment protocols")
            .when(kind == "purchase", F.concat(F.lit("Extract /Volumes/c/s/source_pdfs/patient_"), user, F.lit(".txt")))
            .otherwise("Please refresh the data")
            .alias("content"),
        )

    def message_vectors(self) -> DataFrame:
        """Vectors of the messages that have one, as a query set."""
        vectors = self.raw("embeddings").select(F.col("vec_id").alias("event_id"), "embedding")
        return self.messages().select("event_id", "content").join(vectors, "event_id").select(F.col("event_id").alias("query_id"), "content", "embedding")

    def job_status(self) -> DataFrame:
        """The hot tier: runs whose newest event is recent."""
        newest = F.struct("timestamp", "event_id")
        runs = self.job_events().groupBy("run_id").agg(
            F.max_by(F.struct("triggered_by", "agent", "status", "sp_used", "timestamp"), newest).alias("e"),
            F.min("timestamp").alias("created_at"),
        )
        job = F.create_map(*[F.lit(x) for a in V.AGENTS for x in (a.name, a.job)])
        return runs.filter(F.col("e.timestamp") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")).select(
            F.col("run_id").cast("string").alias("run_id"),
            F.col("e.triggered_by").alias("user_id"),
            F.when(F.col("run_id") % 2 == 0, F.concat(F.lit("conv_"), F.col("e.triggered_by"))).alias("conversation_id"),
            F.try_element_at(job, F.col("e.agent")).alias("job_type"),
            F.col("e.agent").alias("agent"),
            F.col("e.status").alias("status"),
            F.col("e.sp_used").alias("sp_used"),
            "created_at",
            F.col("e.timestamp").alias("updated_at"),
        )

    def checkpoints(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").cast("string").alias("thread_id"),
            F.lit("").alias("checkpoint_ns"),
            F.concat(
                F.lit('{"ts": "'), F.col("ts").cast("string"), F.lit('", "k": '),
                F.regexp_extract("props", "[0-9]+", 0), F.lit("}"),
            ).alias("checkpoint"),
        )

    def agent_usage(self) -> DataFrame:
        return self.as_agent_usage(self.raw("events"))

    @staticmethod
    def as_agent_usage(raw: DataFrame) -> DataFrame:
        return raw.select(
            F.col("event_id").cast("string").alias("invocation_id"),
            _pick(_k() % 3 + 1, [x.name for x in V.AGENTS]).alias("agent_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").alias("timestamp"),
            (_k() * 10).alias("input_tokens"),
            (_k() * 3).alias("output_tokens"),
            (F.col("value") / 100).cast("decimal(10,4)").alias("cost"),
            F.floor(F.col("value") * 10).cast("int").alias("latency_ms"),
            (F.col("event_type") != "error").alias("success"),
        )

    def prompts(self) -> DataFrame:
        return self.raw("events").select(
            F.concat(F.lit("prompt_"), (F.col("user_id") % 20).cast("string")).alias("prompt_id"),
            F.col("event_id").cast("int").alias("version"),
            F.concat(F.lit("prompt body "), F.col("event_id").cast("string")).alias("content"),
            F.col("user_id").cast("string").alias("approved_by"),
            F.col("ts").alias("approved_at"),
            (F.col("event_type") == "purchase").alias("active"),
        )

    def knowledge(self) -> DataFrame:
        docs = self.raw("documents")
        return (
            self.raw("embeddings")
            .join(docs, F.col("vec_id") == F.col("doc_id"))
            .select(
                "vec_id",
                F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
                F.col("text").alias("content"),
                "source",
                "embedding",
            )
        )

    def products(self) -> DataFrame:
        return (
            self.raw("embeddings")
            .join(self.raw("part"), F.col("vec_id") == F.col("p_partkey"))
            .select(
                "vec_id",
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.col("p_retailprice").alias("price"),
                "embedding",
            )
        )

    def product_pages(self) -> DataFrame:
        """Products with the content of their page."""
        pages = self.raw("part").select(
            F.col("p_partkey").alias("vec_id"), F.concat("p_brand", F.lit(", size "), F.col("p_size").cast("string"), F.lit(": "), "p_name").alias("content")
        )
        return self.products().join(pages, "vec_id")
