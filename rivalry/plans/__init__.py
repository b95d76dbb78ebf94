"""The stages of the contest job, each a function of tables."""
