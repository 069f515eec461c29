"""Training-data operators: secrets, joins, classifiers, mixing, media, rules, tokens, chat, records, urls.

Nothing outside this folder imports it; the registered queries are in ``strandline.llm.queries``.
"""
