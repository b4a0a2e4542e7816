"""Plan shapes shared by the operators: joins that stand skew, numbering without one big window, lineage cuts."""
