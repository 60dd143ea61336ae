"""The corpus queries: importing the modules fills the registry."""

from millrace.llm import bpe, chat, decontaminate, jaccard, language, pii, runs, shards, tokencounts, topk, trie, urls, warc

QUERIES: dict = {}
CHECKS: dict[str, str] = {}
for _module in (language, jaccard, decontaminate, bpe, pii, shards, urls, topk, warc, chat, runs, tokencounts, trie):
    QUERIES.update(_module.QUERIES)
    CHECKS.update(_module.CHECKS)
