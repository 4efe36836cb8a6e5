"""Column helpers: nested paths and predicates on them."""
