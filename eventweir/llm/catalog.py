"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from eventweir.llm.bpe import op10_bpe
from eventweir.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from eventweir.llm.decontamination import OP13_SQL, op13_decontaminate
from eventweir.llm.flat_graph import op7_flat_graph
from eventweir.llm.inner_product import OP4_SQL, op4_top_products
from eventweir.llm.language import op1_language
from eventweir.llm.licenses import op6_licences
from eventweir.llm.mixing import OP3_SQL, op3_mix
from eventweir.llm.personal_data import op8_personal_data
from eventweir.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from eventweir.llm.simhash import op5_simhash
from eventweir.llm.toxicity import op9_toxicity
from eventweir.llm.url_filter import op2_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_language,
        op2_url_filter,
        op3_mix,
        op4_top_products,
        op5_simhash,
        op6_licences,
        op7_flat_graph,
        op8_personal_data,
        op9_toxicity,
        op10_bpe,
        op11_conversation_repair,
        op12_prefix_trie,
        op13_decontaminate,
    )
}
ORACLES = {
    "op3_mix": OP3_SQL,
    "op4_top_products": OP4_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_decontaminate": OP13_SQL,
}
