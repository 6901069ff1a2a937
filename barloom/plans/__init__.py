"""Plans that combine operators: feature tables and the whole chain."""
