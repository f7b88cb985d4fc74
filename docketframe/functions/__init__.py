"""Column functions: text in, clean text out, all inside the JVM."""
