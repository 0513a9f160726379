"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from sensorflow.llm.ann import op9_ann
from sensorflow.llm.decontam import op6_decontamination
from sensorflow.llm.embed_dup import OP13_SQL, op13_embedding_dedup
from sensorflow.llm.html_template import op3_main_text
from sensorflow.llm.lexical import OP11_SQL, op11_lexical
from sensorflow.llm.merkle import OP12_SQL, op12_merkle
from sensorflow.llm.near_dup import op8_near_dup
from sensorflow.llm.packing import op5_packing
from sensorflow.llm.pii import op1_pii
from sensorflow.llm.secrets import op10_secret_scan
from sensorflow.llm.toxicity import op2_toxicity
from sensorflow.llm.url_filter import OP4_SQL, op4_url_filter

from sensorflow.llm.warc import op7_warc

QUERIES = {"op1_pii": op1_pii, "op2_toxicity": op2_toxicity, "op3_main_text": op3_main_text, "op4_url_filter": op4_url_filter, "op5_packing": op5_packing, "op6_decontamination": op6_decontamination, "op7_warc": op7_warc, "op8_near_dup": op8_near_dup, "op9_ann": op9_ann, "op10_secret_scan": op10_secret_scan,
           "op11_lexical": op11_lexical, "op12_merkle": op12_merkle, "op13_embedding_dedup": op13_embedding_dedup}
ORACLE = {"op4_url_filter": OP4_SQL, "op11_lexical": OP11_SQL, "op12_merkle": OP12_SQL, "op13_embedding_dedup": OP13_SQL}
