"""The registered queries: one or more per operator, each with the SQL it must agree with."""
