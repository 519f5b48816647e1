"""Result tables and control-room queries, written as DataFrame plans."""
