""""""
