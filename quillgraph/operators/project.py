"""Projects on disk: configuration, scaffolding, run manifests, and the stages chained."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources import documents
from . import collect, gates, graph, ingest, prompts, render, taxonomy
from .taxonomy import Taxonomy, require_lock

try:
    import yaml
except ImportError:  # configuration may then be JSON, which is YAML too
    yaml = None

CONFIG, TAXONOMY, LOCK = "project.yml", "taxonomy.yml", "taxonomy.lock.json"
REVIEW = (".quillgraph", "review")
#: Details of a gate that the report file lists; the table of details always has all.
LISTED = 1000


def _load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) if yaml else json.load(f)


def write_json(path: str, value) -> None:
    """Key-sorted, indented by two, with a final newline."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n")


@dataclass
class Config:
    title: str
    sources: list[dict]
    language: str = "en"
    profile: str = "novel"
    startSegment: int = 1
    maxSegment: int | None = None
    concurrency: int = 4
    includeExcerpts: bool = True
    maxExcerptCharacters: int = 280
    recordings: str | None = None
    output: dict = field(default_factory=lambda: {"data": "data", "obsidian": "content", "site": "site"})

    @classmethod
    def parse(cls, v: dict) -> Config:
        if not v.get("title") or not v.get("sources"):
            raise ValueError("a project needs a title and sources")
        scope, publication, processing = v.get("scope", {}), v.get("publication", {}), v.get("processing", {})
        own = cls(v["title"], v["sources"], v.get("language", "en"), v.get("profile", "novel"), scope.get("startSegment", 1), scope.get("maxSegment"), processing.get("concurrency", 4), publication.get("includeExcerpts", True), publication.get("maxExcerptCharacters", 280), v.get("recordings"))
        own.output |= v.get("output", {})
        if own.startSegment < 1 or (own.maxSegment or 1) < 1 or not 1 <= own.concurrency <= 32:
            raise ValueError("a number of the configuration is out of its range")
        return own

    def value(self) -> dict:
        out = {"schemaVersion": 1, "title": self.title, "language": self.language, "profile": self.profile, "sources": self.sources, "scope": {"startSegment": self.startSegment, "maxSegment": self.maxSegment}, "processing": {"concurrency": self.concurrency}, "publication": {"includeExcerpts": self.includeExcerpts, "maxExcerptCharacters": self.maxExcerptCharacters}, "output": self.output}
        return out | ({"recordings": self.recordings} if self.recordings else {})


def find_root(start: str) -> str:
    at = os.path.abspath(start)
    while not os.path.exists(os.path.join(at, CONFIG)):
        if (up := os.path.dirname(at)) == at:
            raise FileNotFoundError(f"no {CONFIG} above {start}")
        at = up
    return at


@dataclass
class Run:
    """An audit record of a stage; times are never hashed."""

    stage: str
    taxonomyHash: str | None = None
    inputHashes: dict = field(default_factory=dict)
    runId: str = field(default_factory=lambda: uuid.uuid4().hex)
    status: str = "running"
    startedAt: str = field(default_factory=lambda: datetime.now(UTC).isoformat())
    completedAt: str | None = None
    outputHashes: dict = field(default_factory=dict)
    promptVersions: dict = field(default_factory=dict)
    error: str | None = None

    def finish(self, hashes: dict | None = None, error: Exception | None = None) -> Run:
        self.status, self.completedAt = ("failed" if error else "completed"), datetime.now(UTC).isoformat()
        self.outputHashes, self.error = hashes or {}, str(error) if error else None
        return self


class Project:
    """A folder with a configuration, a taxonomy and its lock; stages read and write tables below it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.config = Config.parse(_load(self.path(CONFIG)))

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @classmethod
    def init(cls, spark: SparkSession, root: str, title: str, source: str, profile: str = "novel", recordings: str | None = None) -> Project:
        if os.path.exists(os.path.join(root, CONFIG)):
            raise FileExistsError(f"{root} is a project already")
        config = Config(title, [{"id": "primary", "path": source, "kind": "auto"}], profile=profile, recordings=recordings)
        for folder in ("sources", ".quillgraph/review"):
            os.makedirs(os.path.join(root, folder), exist_ok=True)
        for name, value in ((CONFIG, config.value()), (TAXONOMY, Taxonomy.default(profile).value())):
            with open(os.path.join(root, name), "w", encoding="utf-8") as f:
                f.write(yaml.safe_dump(value, sort_keys=False, allow_unicode=True) if yaml else json.dumps(value))
        return cls(spark, root)

    @property
    def taxonomy(self) -> Taxonomy:
        return Taxonomy.parse(_load(self.path(TAXONOMY)))

    def lock(self) -> dict:
        lock = self.taxonomy.lock()
        write_json(self.path(LOCK), lock)
        return lock

    def locked(self) -> dict | None:
        return _load(self.path(LOCK)) if os.path.exists(self.path(LOCK)) else None

    def table(self, name: str) -> str:
        return self.path(self.config.output["data"], f"{name}.parquet")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.table(name))

    def write(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.table(name))

    def fingerprint(self, name: str) -> str:
        """A hash of a table's rows that does not depend on their order."""
        rows = self.read(name).select(F.xxhash64(F.to_json(F.struct("*"))).alias("h"))
        n, mixed, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor("h"), F.lit(0)), F.coalesce(F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)), F.lit(0))).first()
        return f"{n}-{mixed & (1 << 64) - 1:016x}-{total:x}"

    @contextmanager
    def stage(self, name: str, inputs: tuple[str, ...], outputs: tuple[str, ...], **prompts: str) -> Iterator[None]:
        """Records a run of a stage, failed ones too, with what it has read and written."""
        there = lambda names: {n: self.fingerprint(n) for n in names if os.path.exists(self.table(n))}
        run = Run(name, self.taxonomy.hash(), there(inputs), promptVersions=prompts)
        try:
            yield
        except Exception as error:
            run.finish(error=error)
            raise
        else:
            run.finish(there(outputs))
        finally:
            write_json(self.path(".quillgraph", "runs", f"{run.runId}.json"), asdict(run))

    def ingest(self) -> tuple[DataFrame, DataFrame]:
        with self.stage("ingest", (), ("sources", "segments")):
            sources, segments = ingest.ingest(self.spark, self.config.sources, self.root, self.config.startSegment, self.config.maxSegment)
            self.write("sources", sources)
            self.write("segments", segments)
        return self.read("sources"), self.read("segments")

    def pilot(self, response: str | None = None) -> dict:
        """Takes a pilot's answer, a file or else the recordings' entry, and writes what is to be decided."""
        with self.stage("pilot", ("segments",), (), pilot=prompts.VERSION):
            samples = ingest.stratified(self.read("segments"))
            if response:
                answer = _load(self.path(response))
            elif self.config.recordings:
                told = collect.raw_recorded(self.spark, self.path(self.config.recordings), "pilot").filter("name = ''").first()
                if told is None:
                    raise collect.CollectError("the recordings have no pilot")
                answer = json.loads(told.response)
            else:
                raise collect.CollectError("there is neither a response nor a recording of the pilot")
            taxonomy.check_pilot_evidence(answer, samples)
            rows = [r.asDict() for r in samples.select("id", "ordinal", "title").orderBy("ordinal").collect()]
            write_json(self.path(*REVIEW, "taxonomy-pilot.json"), answer)
            write_json(self.path(*REVIEW, "taxonomy-questions.json"), taxonomy.questions(answer, rows))
            write_json(self.path(*REVIEW, "taxonomy-decisions.yml"), taxonomy.decision_draft(answer))
        return {"proposals": len(answer["proposals"]), "segments": len(rows)}

    def prepare(self, stage: str) -> dict:
        """Writes the work items of a stage as files and empties the folder that its responses go to."""
        if stage == "pilot":
            items = prompts.pilot_item(self.read("segments"), self.taxonomy, self.config.profile, directory=stage)
        else:
            require_lock(self.taxonomy, self.locked(), self.read("segments"))
            items = collect.work_items(self.read("segments"), prompts.EXTRACTION, taxonomy.stable_json(self.taxonomy.value()), stage)
        for folder in ("work", "responses"):
            os.makedirs(self.path(".quillgraph", folder, stage), exist_ok=True)
            render.empty(self.path(".quillgraph", folder, stage))
        written = render.write_pages(items, self.path(".quillgraph", "work"), clear=False)
        return {"items": written, "work": self.path(".quillgraph", "work", stage), "responses": self.path(".quillgraph", "responses", stage), "concurrency": self.config.concurrency}

    def extract(self, responses: str | None = None) -> DataFrame:
        with self.stage("extract", ("segments",), ("extractions", "raw"), extraction=prompts.VERSION):
            segments = self.read("segments")
            require_lock(self.taxonomy, self.locked(), segments)
            if responses:
                given, raw = collect.responses_in(self.spark, responses), collect.raw_in(self.spark, responses)
            elif self.config.recordings:
                path = self.path(self.config.recordings)
                given, raw = collect.recorded(self.spark, path, "extract"), collect.raw_recorded(self.spark, path, "extract")
            else:
                raise collect.CollectError("there are neither responses nor recordings")
            self.write("extractions", collect.collect(segments, given))
            self.write("raw", raw.join(segments.select(F.col("id").alias("name")), "name", "left_semi"))
        return self.read("extractions")

    def normalize(self) -> graph.Graph:
        names = tuple(graph.Graph.__dataclass_fields__)
        with self.stage("normalize", ("segments", "extractions"), names):
            g = graph.normalise(self.read("segments"), self.read("extractions"))
            for name in names:
                self.write(name, getattr(g, name))
        return self.graph()

    def graph(self) -> graph.Graph:
        return graph.Graph(*[self.read(name) for name in graph.Graph.__dataclass_fields__])

    def render(self) -> tuple[int, str]:
        c = self.config
        with self.stage("render", ("segments", "extractions", *graph.Graph.__dataclass_fields__), ("pages",)):
            self.write("pages", render.render(self.read("segments"), self.read("extractions"), self.graph(), self.taxonomy, c.title, c.includeExcerpts, c.maxExcerptCharacters))
            render.write_pages(self.read("pages"), self.path(c.output["obsidian"]))
            files, value = render.digest(self.read("pages"))
            write_json(self.path(".quillgraph", "render-manifest.json"), {"schemaVersion": 1, "files": files, "hash": value})
        return files, value

    def verify(self) -> DataFrame:
        """The report, written beside its details; the report file lists the details of gates that have few."""
        with self.stage("verify", ("segments", "extractions", "raw"), ("report", "details")):
            pages = self.read("pages") if os.path.exists(self.table("pages")) else None
            listed = gates.checks(self.read("segments"), self.read("extractions"), self.graph(), self.taxonomy, self.locked(), self.read("raw"), pages, self.config.maxSegment)
            self.write("details", gates.found(listed))
            self.write("report", gates.report(self.spark, listed, self.read("details")))
            out = self.read("report")
            few = [r.id for r in out.collect() if 0 < r.n <= LISTED]
            told: dict[str, list[str]] = {}
            for r in self.read("details").filter(F.col("id").isin(few)).orderBy("id", "detail").collect():
                told.setdefault(r.id, []).append(r.detail)
            rows = [r.asDict() | {"details": told.get(r.id, []) if r.n <= LISTED else self.table("details")} for r in out.collect()]
            write_json(self.path(".quillgraph", "verification-report.json"), {"generatedAt": datetime.now(UTC).isoformat(), "passed": gates.passes(out), "gates": rows})
        return out

    def build(self, responses: str | None = None) -> DataFrame:
        self.ingest()
        self.extract(responses)
        self.normalize()
        self.render()
        return self.verify()


def export(project: Project, directory: str) -> None:
    """The tables as one JSON object a line."""
    for name in ("segments", "extractions", "entities", "claims", "relationships", "passages", "questions", "merges", "issues"):
        documents.write_json_lines(project.read(name), os.path.join(directory, f"{name}.jsonl"), *(["id"] if "id" in schemas.__dict__.get(name.upper()).names else ["mergedName"] if name == "merges" else []))
