"""Whole plans: silver, gold, checks, measures and report queries."""
