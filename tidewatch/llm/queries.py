"""Queries over the whole tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, filter_audit, licenses, line_dedup, mil, packing, quality_rules, secret_scan, simhash, spelling, token_files, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality_rules.query,
        "op2_packing": packing.query,
        "op3_token_files": token_files.query,
        "op4_simhash": simhash.query,
        "op5_warc": warc.query,
        "op6_bpe": bpe.query,
        "op7_ann": ann.query,
        "op8_licenses": licenses.query,
        "op9_quality_classifier": mil.query,
        "op10_secrets": secret_scan.query,
        "op11_spelling": spelling.query,
        "op12_filter_audit": filter_audit.query,
        "op13_line_dedup": line_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.oracle(),
        "op5_warc": warc.oracle(),
        "op12_filter_audit": filter_audit.oracle(),
        "op13_line_dedup": line_dedup.oracle(),
    }
