"""wiremap: network-map analytics as reusable Spark DataFrame operators.

Layers: raw capture files -> bronze (append + provenance) -> silver
(latest row per key, host lookup, keyed upsert) -> gold (packet map,
connection map) -> report (graph nodes, edges, networks).
"""

__version__ = "0.1.0"
