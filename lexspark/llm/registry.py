"""The operators' queries over whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from lexspark.llm.ball_tree import OP11_SQL, op11_lexical_search
from lexspark.llm.chat_template import OP4_SQL, op4_chat_format
from lexspark.llm.collocations import OP13_SQL, op13_collocations
from lexspark.llm.decontaminate import op9_decontamination
from lexspark.llm.embedding_graph import op6_embedding_graph
from lexspark.llm.langid import op8_language_id
from lexspark.llm.oracles import OP6_SQL, OP7_SQL, OP9_SQL
from lexspark.llm.packing import op10_packing
from lexspark.llm.repeats import OP12_SQL, op12_repeats
from lexspark.llm.secrets import op7_secrets
from lexspark.llm.simhash import op3_simhash
from lexspark.llm.token_counts import op1_token_counts
from lexspark.llm.url_filter import OP5_SQL, op5_url_filter
from lexspark.llm.wavelet import op2_token_ids

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_token_ids, op3_simhash, op4_chat_format, op5_url_filter, op6_embedding_graph, op7_secrets, op8_language_id, op9_decontamination, op10_packing, op11_lexical_search, op12_repeats, op13_collocations)}

ORACLE_SQL: dict[str, str] = {"op4_chat_format": OP4_SQL, "op5_url_filter": OP5_SQL, "op6_embedding_graph": OP6_SQL, "op7_secrets": OP7_SQL, "op9_decontamination": OP9_SQL, "op11_lexical_search": OP11_SQL, "op12_repeats": OP12_SQL, "op13_collocations": OP13_SQL}
