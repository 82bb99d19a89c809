"""The questions, marts, inferences and reports, built from the operators."""
