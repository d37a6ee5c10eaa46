"""End-to-end plans composed of operators."""
