"""Registered queries of the subpackage and their SQL."""

from mnemoweave.llm.plans import language, neardup, pii, secrets, splitting, tokens

MODULES = (language, neardup, pii, secrets, splitting, tokens)
