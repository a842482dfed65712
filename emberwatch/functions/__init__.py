"""Column expressions: columns in, columns out, all inside the JVM."""
