"""Training-data operators. Nothing else in the library imports this subpackage.

Every operator is a DataFrame-to-DataFrame function with its own general
interface; the module :mod:`attestra.llm.queries` wires the digest queries.
"""
