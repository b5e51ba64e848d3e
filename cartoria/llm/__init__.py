"""Operators for building text corpora and entity registries; nothing outside this subpackage imports it."""

from __future__ import annotations

from cartoria.llm import addresses, collective, formatting, lookalikes, packing, sentences, survivor, tokens, variants

MODULES = [formatting, survivor, lookalikes, tokens, packing, sentences, addresses, variants, collective]
