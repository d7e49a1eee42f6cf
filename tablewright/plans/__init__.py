"""Layer plans built from the operators, a preset and the job edge."""
