"""Operators: rule chains, dedupe, membership checks, imputation, aggregates,
expectations and typed conforming."""
