"""bulwark: guarding, perturbing, scoring and measuring labelled text corpora with Spark."""
