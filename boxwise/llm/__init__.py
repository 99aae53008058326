"""Training-data operators for text corpora.

Nothing outside this subpackage imports it; its queries and oracle SQL are in
``boxwise.llm.queries``.
"""
