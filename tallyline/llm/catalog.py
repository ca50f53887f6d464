"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from tallyline.llm.centroids import ORACLE_SQL as CENTROID_SQL
from tallyline.llm.centroids import op13_lookup_centroids
from tallyline.llm.decontaminate import op2_wu_manber
from tallyline.llm.lattice import op1_subword_lattice
from tallyline.llm.licenses import op4_license_dice
from tallyline.llm.manifest import ORACLE_SQL as MANIFEST_SQL
from tallyline.llm.manifest import op11_time_forward
from tallyline.llm.near_duplicates import op8_min_max
from tallyline.llm.packing import op9_cost_packing
from tallyline.llm.personal_data import op12_skip_chain
from tallyline.llm.quality import op5_js_divergence
from tallyline.llm.repeats import op3_column_bwt
from tallyline.llm.secret_scan import op7_markov_secrets
from tallyline.llm.url_rules import ORACLE_SQL as URL_SQL
from tallyline.llm.url_rules import op6_redirect_components
from tallyline.llm.wrapper import op10_tree_wrapper

QUERIES = {
    "op1_subword_lattice": op1_subword_lattice,
    "op2_wu_manber": op2_wu_manber,
    "op3_column_bwt": op3_column_bwt,
    "op4_license_dice": op4_license_dice,
    "op5_js_divergence": op5_js_divergence,
    "op6_redirect_components": op6_redirect_components,
    "op7_markov_secrets": op7_markov_secrets,
    "op8_min_max": op8_min_max,
    "op9_cost_packing": op9_cost_packing,
    "op10_tree_wrapper": op10_tree_wrapper,
    "op11_time_forward": op11_time_forward,
    "op12_skip_chain": op12_skip_chain,
    "op13_lookup_centroids": op13_lookup_centroids,
}

# The other operators are beyond SQL: tests compare them with brute force. The
# pages of the test tables declare no links, so rules alone decide there; links
# and components are tested apart.
ORACLE_SQL: dict[str, str] = {"op6_redirect_components": URL_SQL, "op11_time_forward": MANIFEST_SQL, "op13_lookup_centroids": CENTROID_SQL}
