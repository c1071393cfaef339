"""Declarative feature plans and the rules that write them."""
