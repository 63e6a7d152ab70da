"""Column functions without Python code on the executors."""
