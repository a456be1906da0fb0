"""Command line: ``python -m weftline`` (or spark-submit) COMMAND INPUT [OUTPUT].

``run`` is all stages; ``segment``, ``embed``, ``detect`` and ``enrich`` are one each, from the
files that the one before wrote.  Flags go over the configuration.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from weftline.operators.profile import jsonl_profile
from weftline.plans import pipeline
from weftline.plans.config import PipelineConfig, from_yaml
from weftline.sources import readers, writers


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="weftline", description=__doc__)
    parser.add_argument("command", choices=["run", *pipeline.STAGES, "align", "transliterate", "to-jsonl", "profile", "purge"])
    parser.add_argument("input", help="JSON lines (run, segment, profile), segments (embed), vectors (detect), matches (enrich), a folder of .txt files (align, transliterate, to-jsonl) or of outputs (purge)")
    parser.add_argument("output", nargs="?", help="folder to write")
    parser.add_argument("--corpus", help="align each input text with each text of this folder")
    parser.add_argument("--config", help="YAML configuration")
    parser.add_argument("--skip", action="append", default=[], choices=pipeline.STAGES, help="leave out this stage and those after it")
    parser.add_argument("--mode", default="seed", help="align: seed, or anything else for whole texts")
    parser.add_argument("--delete", action="store_true", help="purge: delete what is listed")
    parser.add_argument("--format", help="output format: parquet, csv or json")
    _stage_flags(parser)
    o = parser.parse_args(args)
    config = _overridden(from_yaml(o.config) if o.config else PipelineConfig(), o)
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    if o.command == "profile":
        jsonl_profile(spark.read.text(o.input)).show(truncate=False)
        return
    if o.command == "purge":
        print(*writers.purge(spark, [o.input], dry_run=not o.delete), sep="\n")
        return
    lines = None
    if not o.output:
        parser.error("an output folder is needed")
    if o.command == "transliterate":
        writers.write_transliterated(readers.read_texts(spark, o.input), o.output)
        return
    if o.command == "to-jsonl":
        writers.write_documents(readers.texts_as_documents(readers.read_texts(spark, o.input)), o.output)
        return
    if o.command == "align":
        texts = readers.read_texts(spark, o.input)
        corpus = readers.read_texts(spark, o.corpus, "corpus/", recursive=True) if o.corpus else None
        writers.write_alignments(pipeline.align_documents(texts, corpus, config, o.mode), o.output)
        return
    if o.command == "embed":
        segments = readers.read_segments(spark, o.input, o.max_segments)
        if o.skip_existing and o.layout != "combined":
            by = {"per_file": "Source_File", "per_line": "Source_Line_Number"}[o.layout]
            writers.write_missing_vectors(segments, lambda part: pipeline.embed_segments(part, config), o.output, by).show(truncate=False)
            return
        summary = writers.write_vectors(pipeline.embed_segments(segments, config), o.output, o.layout, o.skip_existing)
        summary.show(truncate=False)
        return
    if o.command in ("run", "segment"):
        docs = readers.read_documents(spark, o.input).select("line_number", "text", F.col("file_id"))
        docs = docs.observe(lines := Observation("lines"), F.count(F.lit(1)).alias("lines"))
        set_aside = (lambda failed: failed.write.mode("overwrite").json(o.failed)) if o.failed else None
        if o.command == "segment":
            if set_aside:
                good, failed = pipeline.segment_or_fail(docs, config.segment)
                set_aside(failed)
            else:
                good = pipeline.segment_documents(docs, config.segment)
            found = pipeline.output_segments(good)
            print(writers.write_segments(found, o.output, config.segment.mode == "overlapping", o.single_lines))
            print(f"lines: {lines.get['lines']}")
            return
        found = pipeline.run(docs, config, tuple(o.skip), set_aside)
    elif o.command == "detect":
        found = pipeline.detect_matches(readers.read_vectors(spark, o.input, o.line or None), config)
    else:
        vectors = readers.read_vectors(spark, o.vectors) if o.vectors else None
        found = pipeline.enrich_matches(readers.read_matches(spark, o.input, o.input_format), vectors, config)
    found = found.observe(matches := Observation("matches"), F.count(F.lit(1)).alias("matches"))
    writers.write_matches(found, o.output, o.format or config.output.form, config.output.include_text, config.output.rows_per_file, config.output.encoding)
    if lines:
        print(f"lines: {lines.get['lines']}")
    print(f"rows written: {matches.get['matches']}")


def _stage_flags(parser: argparse.ArgumentParser) -> None:
    seg = parser.add_argument_group("segment")
    seg.add_argument("--profile")
    seg.add_argument("--engine", choices=["rules", "tokens", "legacy"])
    seg.add_argument("--mode-of-segments", dest="segment_mode", choices=["exclusive", "overlapping"])
    for name in ("min-syllables", "max-syllables", "min-words", "max-words", "max-atoms"):
        seg.add_argument(f"--{name}", type=int)
    seg.add_argument("--keep-spaces", dest="remove_spaces", action="store_false", default=None)
    seg.add_argument("--keep-foreign", dest="clean_foreign", action="store_false", default=None)
    seg.add_argument("--failed", help="folder for rows that can't be segmented; without it such a row fails the job")
    seg.add_argument("--single-lines", action="store_true", help="a folder for each source line")
    emb = parser.add_argument_group("embed")
    emb.add_argument("--layout", default="combined", choices=["combined", "per_file", "per_line"])
    emb.add_argument("--dual-layer", action="store_true", default=None)
    emb.add_argument("--original-script", dest="transliterate", action="store_false", default=None, help="embed the text, not its transliteration")
    emb.add_argument("--batch", type=int, help="texts per call of the encoder")
    emb.add_argument("--model", help="package.module:factory of a model that gives hidden states")
    emb.add_argument("--device", help="what the model's factory is told")
    emb.add_argument("--max-length", type=int, help="tokens of a text that the model sees")
    emb.add_argument("--batch-tokens", type=int, help="padded tokens per call of the model")
    emb.add_argument("--max-segments", type=int)
    emb.add_argument("--skip-existing", action="store_true")
    det = parser.add_argument_group("detect")
    det.add_argument("--strategy", choices=["threshold", "knn"])
    det.add_argument("--threshold", type=float)
    det.add_argument("--k", type=int)
    det.add_argument("--batch-size", type=int, help="corpus files per index batch")
    det.add_argument("--line", type=int, action="append", help="only the corpus file of this source line (repeatable)")
    parser.add_argument("--no-normalize", dest="normalize", action="store_false", default=None, help="embed, detect: vectors as they are")
    enr = parser.add_argument_group("enrich")
    enr.add_argument("--input-format", default="parquet", choices=["parquet", "csv", "json"])
    enr.add_argument("--vectors", help="vectors with a lexical layer")
    enr.add_argument("--enricher", action="append")


def _overridden(c: PipelineConfig, o: argparse.Namespace) -> PipelineConfig:
    """The configuration with the flags that were given."""
    given = lambda part, *names: replace(part, **{n: getattr(o, n) for n in names if getattr(o, n) is not None})
    segment = given(
        c.segment, "profile", "engine", "min_syllables", "max_syllables", "min_words", "max_words", "max_atoms", "remove_spaces", "clean_foreign"
    )
    return replace(
        c,
        segment=replace(segment, mode=o.segment_mode) if o.segment_mode else segment,
        embed=given(c.embed, "dual_layer", "transliterate", "batch", "normalize", "model", "device", "max_length", "batch_tokens"),
        detect=given(c.detect, "strategy", "threshold", "k", "batch_size", "normalize"),
        enrichers=tuple({"name": n} for n in o.enricher) if o.enricher else c.enrichers,
    )


if __name__ == "__main__":
    main()
