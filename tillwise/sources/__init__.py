"""Readers, writers, shared-storage staging and the benchmark star mapping."""
