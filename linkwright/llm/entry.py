"""The subpackage's queries and their SQL, added to the repository's by __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import warc
from .decontaminate import OP7_SQL, op7_decontamination
from .forest import op8_nearest_neighbours
from .language import op2_language_id
from . import licenses
from .lines import op9_line_dedup
from .minhash import OP1_SQL, op1_minhash_dedup
from .mixing import op10_mixing
from .quality import op3_quality_classifier
from .suffix import OP5_SQL, op5_suffix_dedup

_ALL = (op1_minhash_dedup, op2_language_id, op3_quality_classifier, licenses.op4_license_scan, op5_suffix_dedup, warc.op6_warc, op7_decontamination, op8_nearest_neighbours, op9_line_dedup, op10_mixing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": OP1_SQL, "op7_decontamination": OP7_SQL, "op4_license_scan": licenses.sql(), "op5_suffix_dedup": OP5_SQL, "op6_warc": warc.OP6_SQL}
