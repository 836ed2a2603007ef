"""The corpus operators' registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.alignment import op13_alignment
from wayfare.llm.bpe import op6_bpe
from wayfare.llm.classlm import op7_classlm
from wayfare.llm.collocations import OP12_SQL, op12_collocations
from wayfare.llm.hamming import OP3_SQL, op3_hamming
from wayfare.llm.language import op11_language
from wayfare.llm.licenses import op1_licenses
from wayfare.llm.neardup import OP5_SQL, op5_neardup
from wayfare.llm.packing import op4_packing
from wayfare.llm.pii import op2_pii
from wayfare.llm.quality import op10_quality
from wayfare.llm.substrings import op8_substrings
from wayfare.llm.syncmers import op9_syncmers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_licenses, op2_pii, op3_hamming, op4_packing, op5_neardup, op6_bpe, op7_classlm, op8_substrings, op9_syncmers, op10_quality, op11_language, op12_collocations, op13_alignment)}
SQL: dict[str, str] = {"op3_hamming": OP3_SQL, "op5_neardup": OP5_SQL, "op12_collocations": OP12_SQL}
