"""Column helpers; all of them build JVM-side expressions."""
