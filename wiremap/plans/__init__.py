"""Composite plans: gold packet map, connection map, report graph.

Import from the modules (``wiremap.plans.packet_map``, ``.connection_map``,
``.graph``); nothing is re-exported here so module and function names never
shadow each other.
"""
