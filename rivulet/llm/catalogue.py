"""Queries and DuckDB SQL of the operators in this subpackage."""

from __future__ import annotations

from rivulet.llm.decontaminate import OP3_SQL, op3_decontaminate
from rivulet.llm.langid import op8_langid
from rivulet.llm.licences import op4_licences
from rivulet.llm.linededup import OP6_SQL, op6_lines
from rivulet.llm.merkle import OP13_SQL, op13_manifest
from rivulet.llm.packing import op10_pack
from rivulet.llm.passages import op2_passages
from rivulet.llm.periodic import op12_runs
from rivulet.llm.personal import op11_personal
from rivulet.llm.preference import OP1_SQL, op1_preference
from rivulet.llm.simhash import op7_simhash
from rivulet.llm.toxicity import op9_toxicity
from rivulet.llm.vectors import OP5_SQL, op5_vectors

QUERIES = {"op1_preference": op1_preference, "op2_passages": op2_passages,
           "op3_decontaminate": op3_decontaminate, "op4_licences": op4_licences, "op5_vectors": op5_vectors,
           "op6_lines": op6_lines, "op7_simhash": op7_simhash, "op8_langid": op8_langid, "op9_toxicity": op9_toxicity, "op10_pack": op10_pack,
           "op11_personal": op11_personal, "op12_runs": op12_runs, "op13_manifest": op13_manifest}
ORACLES = {"op1_preference": OP1_SQL, "op3_decontaminate": OP3_SQL, "op5_vectors": OP5_SQL, "op6_lines": OP6_SQL, "op13_manifest": OP13_SQL}
