"""Inputs, registered queries and their SQL counterparts for the correctness check and the bench."""
