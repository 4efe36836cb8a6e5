"""Reading, writing and maintaining tables, and the nested inputs derived from flat ones."""
